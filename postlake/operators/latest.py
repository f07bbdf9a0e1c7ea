"""Keeping one row, or the top k rows, per key.

All are a `row_number` filter. Spark turns that into a group limit on both sides
of the shuffle: every map task first drops all but its own best rows per key, so
a key holding a large share of the rows crosses the network as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _rest(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """Remaining columns as a tie break, which makes the order total."""
    return [F.col(c).desc_nulls_last() for c in df.columns if c not in used]


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first k rows of each key in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= k).drop("_rank")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] = ("url",),
    date: str = "crawl_date",
    tie: Sequence[Column] | None = None,
) -> DataFrame:
    """The newest row of each key. Ties go by `tie`, or by the other columns."""
    tie = _rest(df, [*keys, date]) if tie is None else list(tie)
    return top_per_key(df, keys, [F.col(date).desc_nulls_last(), *tie])


def distinct_crawls(
    df: DataFrame,
    keys: Sequence[str] = ("url", "crawl_date"),
    tie: Sequence[Column] | None = None,
) -> DataFrame:
    """One row per url and crawl date."""
    return top_per_key(df, keys, _rest(df, keys) if tie is None else list(tie))
