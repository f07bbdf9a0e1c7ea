"""Search index rows: target index, document id and document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.functions.dates import index_name, post_ts
from postlake.functions.payload import index_json

# The name an index starts with; a deployment sets its own.
PREFIX = "posts-monthly-"


def index_rows(posts: DataFrame, prefix: str = PREFIX, strict: bool = False) -> DataFrame:
    """`index_name, _id, source` of detailed posts."""
    return posts.select(
        index_name(prefix, post_ts("date", strict)).alias("index_name"),
        F.col("url").alias("_id"),
        index_json().alias("source"),
    )


def send(rows: DataFrame, fmt: str, **options: str) -> None:
    """Write index rows through a search connector on the class path.

    The connector's options pick the index and id columns, and its bulk size.
    """
    rows.write.format(fmt).options(**options).mode("append").save()
