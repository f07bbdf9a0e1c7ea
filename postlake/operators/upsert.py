"""Upserts as DataFrame operators: rows to write, and the table after them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.operators.latest import top_per_key


def newest_saved(saved: DataFrame, keys: Sequence[str] = ("url",), date: str = "crawl_date") -> DataFrame:
    """Newest date per key. Reads two columns and combines before the shuffle."""
    return saved.groupBy(*keys).agg(F.max(date).alias("_saved"))


def conditional_upsert(
    new: DataFrame, saved: DataFrame, keys: Sequence[str] = ("url",), date: str = "crawl_date"
) -> DataFrame:
    """Rows of `new` whose key is not saved, or saved with a strictly older date.

    A tie keeps the saved row. `new` holds one row per key; the join reuses the
    partitioning that made it so.
    """
    joined = new.join(newest_saved(saved, keys, date), list(keys), "left")
    return joined.where(F.col("_saved").isNull() | (F.col("_saved") < F.col(date))).drop("_saved")


def merge_newest(
    saved: DataFrame, new: DataFrame, keys: Sequence[str] = ("url",), date: str = "crawl_date"
) -> DataFrame:
    """The whole table after an upsert where only a strictly newer row replaces."""
    rows = saved.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    rest = [F.col(c).desc_nulls_last() for c in saved.columns if c not in (*keys, date)]
    order = [F.col(date).desc_nulls_last(), F.col("_new"), *rest]
    return top_per_key(rows, keys, order).drop("_new")


def merge_into(
    saved: DataFrame, new: DataFrame, keys: Sequence[str], date: str | None = "crawl_date", ties_keep_saved: bool = True
) -> DataFrame:
    """The rows of `saved` after an upsert, where both sides have one row per key. A saved row stays if its date is newer, or the
    same with `ties_keep_saved`; without a date every new row replaces. A join on the keys does it, so a side that is bucketed
    by them is not shuffled. A null key is an error."""
    # A filter leaves the keys as they are, so rows that are dealt and sorted by them already are not again.
    for key in keys:
        failed = F.raise_error(F.lit(f"a row without {key} has no place in a keyed table")).cast("boolean")
        new = new.where(F.when(F.col(key).isNull(), failed).otherwise(True))
    named = new.select(*[F.col(c).alias(f"_new_{c}") for c in saved.columns], F.lit(True).alias("_is_new"))
    on = reduce(lambda a, b: a & b, [F.col(key) == F.col(f"_new_{key}") for key in keys])
    # No key is null, so a null one stands for a missing side.
    wins = F.col(keys[0]).isNull()
    if date is None:
        wins = wins | F.col("_is_new")
    else:
        before, after = F.col(date), F.col(f"_new_{date}")
        newer = after > before if ties_keep_saved else after >= before
        wins = wins | (F.col("_is_new") & (F.coalesce(newer, before.isNull() & (after.isNotNull() | F.lit(not ties_keep_saved)))))
    wins = F.coalesce(wins, F.lit(False))
    joined = saved.join(named, on, "full_outer")
    return joined.select(*[F.when(wins, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in saved.columns])
