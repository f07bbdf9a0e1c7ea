"""Export of the index queue to files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from postlake.functions.dates import local_date
from postlake.operators.filters import nonempty_body
from postlake.schemas import EXPORT
from postlake.tables import Lake


def exportable(posts: DataFrame, strict: bool = False) -> DataFrame:
    """Detailed posts with text, and their local date as a column to filter on."""
    dated = nonempty_body(posts).withColumn("post_local_date", local_date("date", strict))
    return dated.select(*EXPORT.names)


def export_for_index(lake: Lake, path: str, strict: bool = False) -> None:
    """Overwrite a folder with the queue's posts that have text. Posts without a
    readable date are set aside, in a second pass if the first has seen any."""
    counts = Observation()
    undated = F.count_if(F.col("post_local_date").isNull())
    rows = exportable(lake.post_to_es.read(), strict).observe(counts, undated.alias("undated"))
    rows.where(F.col("post_local_date").isNotNull()).write.mode("overwrite").parquet(path)
    if counts.get["undated"]:
        lake.undated.append(exportable(lake.post_to_es.read()).where("post_local_date IS NULL"))
