"""Tables whose rows are JSON cells: `id string, crawl_date bigint, json string`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postlake.functions.payload import CORRUPT, decode_cells

CELLS = "id string, crawl_date bigint, json string"


def read_cells(spark: SparkSession, path: str, kind: str, strict: bool = False) -> DataFrame:
    """Typed records of a `profile`, `post` or `detailed` cell table."""
    return decode_cells(spark.read.schema(CELLS).parquet(path), kind, strict)


def readable(records: DataFrame) -> DataFrame:
    return records.where(f"{CORRUPT} IS NULL").drop(CORRUPT)


def unreadable(records: DataFrame) -> DataFrame:
    return records.where(f"{CORRUPT} IS NOT NULL").select("url", "crawl_date", CORRUPT)
