"""Filters of two bits a member, to leave out early what a later exact step would drop. Their size grows with the members up to
`FILTER_WORDS`; beyond it more passes that is no member. None ever holds a member back."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_WORDS = 1 << 22  # 64 bits each, 32 MB
BITS_A_MEMBER = 16


def spots(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The word of a table of a power of two words, and the bits in it, for each hash."""
    bits = (np.uint64(1) << (hashes & np.uint64(63))) | (np.uint64(1) << ((hashes >> np.uint64(6)) & np.uint64(63)))
    return ((hashes >> np.uint64(12)) & np.uint64(size - 1)).astype(np.int64), bits


class Filter:
    """Which hashes are in a set."""

    def __init__(self, table: np.ndarray):
        self.table = table

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place, bits = spots(hashes, len(self.table))
        return self.table[place] & bits == bits


def filter_of(members: DataFrame) -> Filter:
    """Of the 64-bit hashes in the one column of `members`. The driver gets a table of bounded size."""
    rows = members.toDF("hash")
    wanted = max(rows.count() * BITS_A_MEMBER // 64, 1)
    size = min(1 << int(wanted - 1).bit_length(), FILTER_WORDS)
    at = F.shiftrightunsigned("hash", 12).bitwiseAND(F.lit(size - 1))
    one, other = F.expr("cast(hash & 63 AS int)"), F.expr("cast(shiftrightunsigned(hash, 6) & 63 AS int)")
    bits = F.call_function("shiftleft", F.lit(1).cast("bigint"), one).bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), other))
    found = rows.select(at.alias("place"), bits.alias("bits")).groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(size, np.uint64)
    table[found.column("place").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return Filter(table)
