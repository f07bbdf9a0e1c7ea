"""Parquet folders written by an earlier job, as a batch or as a stream."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from postlake import files
from postlake.session import empty

LOGGER = logging.getLogger(__name__)


def _check(spark: SparkSession, pattern: str, missing: str) -> bool:
    if files.matching(spark, pattern):
        return True
    if missing == "skip":
        LOGGER.info("skip %s: no such path", pattern)
        return False
    raise FileNotFoundError(f"no such path: {pattern}")


def read_export(
    spark: SparkSession, path: str, schema: StructType, missing: str = "fail"
) -> DataFrame:
    """Rows under a path or glob. With `missing="skip"` a path that does not
    exist gives no rows instead of an error."""
    if not _check(spark, path, missing):
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(path)


def stream_export(
    spark: SparkSession,
    path: str,
    schema: StructType,
    missing: str = "fail",
    max_files: int | None = None,
    max_bytes: int | None = None,
    archive: str | None = None,
) -> DataFrame | None:
    """The same as a stream, or None for a path that is missing and skipped.

    A micro-batch takes up to `max_files` files, or `max_bytes` and the file that passes them, so an export of any size is read
    in batches of bounded size. Files whose batch is done go to the `archive` folder, under their own path.
    """
    if not _check(spark, path, missing):
        return None
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.parquet(path)
