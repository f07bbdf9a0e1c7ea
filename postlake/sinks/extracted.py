"""Extracted records: `{root}/from_segment={name}/kind={kind}/`.

One pass writes all kinds, so the pages are assembled once and nothing has to be
cached to be split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from postlake import files
from postlake.operators.layout import group_for_write, sort_locally
from postlake.schemas import BY_KIND, EXTRACTED, record
from postlake.session import empty

KINDS = (*BY_KIND, "quarantine")
FOLDERS = ("from_segment", "kind")
QUARANTINE = record("url", "crawl_date", "segment", "date", "reason")


def folder(root: str, segment: str, kind: str) -> str:
    return f"{root}/from_segment={segment}/kind={kind}"


def write_extracted(records: DataFrame, root: str, segments: Sequence[str]) -> None:
    """Overwrite the output of the given segments; others stay.

    Spark puts the new folders in place of the old when the job commits, so a job
    that fails leaves the old output. A kind that a segment no longer yields is
    deleted after that.
    """
    spark = records.sparkSession
    before = {s: set(files.matching(spark, f"{folder(root, s, '*')}/part-*")) for s in segments}
    rows = sort_locally(group_for_write(records, *FOLDERS), *FOLDERS, "url")
    rows = rows.select("from_segment", *EXTRACTED.names)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*FOLDERS).parquet(root)
    for segment, old in before.items():
        for path in {path.rsplit("/", 1)[0] for path in old}:
            if old.issuperset(files.matching(spark, f"{path}/part-*")):
                files.delete(spark, path)


def read_extracted(spark: SparkSession, root: str, kind: str, segments: Sequence[str]) -> DataFrame:
    """Records of one kind from the given segments."""
    schema = BY_KIND.get(kind, QUARANTINE)
    wanted = {f"from_segment={segment}" for segment in segments}
    found = files.matching(spark, folder(root, "*", kind))
    paths = [path for path in found if path.split("/")[-2] in wanted]
    if not paths:
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(*paths)
