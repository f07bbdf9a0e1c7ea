"""How rows are spread and ordered; none of these changes the result."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Even redistribution of the rows, into as many partitions as AQE sees fit
    unless told."""
    return df.repartition(partitions) if partitions else df.hint("rebalance")


def sort_locally(df: DataFrame, *columns: str) -> DataFrame:
    """Order inside each partition."""
    return df.sortWithinPartitions(*(columns or ("url",)))


def group_for_write(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of the same output folder together, so that few files are
    written; a folder with very many rows is split over several tasks by AQE."""
    return df.hint("rebalance", *columns)
