"""Exact dedup against a history, through a minimal perfect hash over its distinct digests.

The digests of the history are dealt to parts of a few thousand by hash. Each part gets a minimal perfect hash (hash and
displace): a seed for each small bucket of digests, found so that the n digests of the part fill n slots. A slot holds the
full digest, the row that wins so far and the number of its copies. A lookup computes a slot, compares all 32 bytes, and is
a repeat only if they agree; digests that the history lacks are grouped among themselves.

Copies are counted and their winners chosen before anything is dealt by digest, so a text with a third of all rows is one
row in each task's output. Parts hold distinct digests, so none is hot.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import GOLDEN, mix, written

PART_DIGESTS = 4096
BUCKET_DIGESTS = 4
TRIALS = 256
INDEX = "part bigint, seeds binary, digests binary, winners array<bigint>, copies array<bigint>"
GROUPS = "digest binary, keep_id bigint, group_size bigint"


def _hashes(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit words of each digest (rows of 32 bytes)."""
    words = np.ascontiguousarray(digests).view(np.uint64)
    return words[:, 0], words[:, 1]


def _spread(h: np.ndarray, seed: np.ndarray, n: int) -> np.ndarray:
    return (mix(h ^ ((seed.astype(np.uint64) + np.uint64(1)) * GOLDEN)) % np.uint64(n)).astype(np.int64)


def perfect_hash(digests: np.ndarray) -> np.ndarray:
    """Seeds of the buckets, such that `slots` sends n distinct digests to n slots."""
    n = len(digests)
    buckets = -(-n // BUCKET_DIGESTS)
    first, second = _hashes(digests)
    bucket = (first % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    starts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    sizes = np.diff(starts)
    seeds, used = np.zeros(buckets, np.int64), np.zeros(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        members = second[order[starts[b] : starts[b + 1]]]
        if len(members) < 2:
            break
        base = 0
        while True:
            tried = np.arange(base, base + TRIALS)
            at = np.sort(_spread(members[None, :], tried[:, None], n), axis=1)
            fits = ~used[at].any(axis=1) & (np.diff(at, axis=1) > 0).all(axis=1)
            if fits.any():
                k = int(fits.argmax())
                seeds[b], used[at[k]] = base + k, True
                break
            base += TRIALS
    # A lone digest takes any slot that is left; its seed names the slot.
    alone = np.flatnonzero(sizes == 1)
    seeds[alone] = -1 - np.flatnonzero(~used)
    return seeds


def slots(digests: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    first, second = _hashes(digests)
    seed = seeds[(first % np.uint64(len(seeds))).astype(np.int64)]
    return np.where(seed < 0, -1 - seed, _spread(second, np.maximum(seed, 0), n))


def _rows(column: pa.ChunkedArray) -> np.ndarray:
    """Digests as rows of 32 bytes."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(-1, 32)


def _build(table: pa.Table) -> pa.Table:
    digests = _rows(table["digest"])
    seeds = perfect_hash(digests)
    at = slots(digests, seeds, len(digests))
    back = np.empty(len(at), np.int64)
    back[at] = np.arange(len(at))
    placed = table.take(pa.array(back))
    return pa.table({
        "part": pa.array([table["part"][0].as_py()], pa.int64()),
        "seeds": pa.array([seeds.tobytes()], pa.binary()),
        "digests": pa.array([digests[back].tobytes()], pa.binary()),
        "winners": pa.array([placed["winner"].to_pylist()], pa.list_(pa.int64())),
        "copies": pa.array([placed["copies"].to_pylist()], pa.list_(pa.int64())),
    })


def _larger(a: int | None, b: int | None) -> int | None:
    return a if b is None else b if a is None else max(a, b)


def _lookup(incoming: pa.Table, index: pa.Table) -> pa.Table:
    keys, winners, copies = [], [], []
    if index.num_rows:
        row = index.to_pylist()[0]
        keys = [row["digests"][i : i + 32] for i in range(0, len(row["digests"]), 32)]
        winners, copies = row["winners"], row["copies"]
    if incoming.num_rows:
        asked = _rows(incoming["digest"])
        member = np.zeros(len(asked), bool)
        at = np.zeros(len(asked), np.int64)
        if keys:
            at = slots(asked, np.frombuffer(row["seeds"], np.int64), len(keys))
            held = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
            member = (held[at] == asked).all(axis=1)
        for i, (digest, winner, count) in enumerate(zip(*(incoming[c].to_pylist() for c in ("digest", "winner", "copies")))):
            if member[i]:
                winners[at[i]] = _larger(winners[at[i]], winner)
                copies[at[i]] += count
            else:
                keys.append(digest)
                winners.append(winner)
                copies.append(count)
    return pa.table({
        "digest": pa.array(keys, pa.binary()),
        "keep_id": pa.array(winners, pa.int64()),
        "group_size": pa.array(copies, pa.int64()),
    })


def _distinct(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("id").alias("winner"), F.count(F.lit(1)).alias("copies"))


def build_index(history: DataFrame, parts: int) -> DataFrame:
    """The hash over the distinct digests of `history` (digest, winner, copies): one row for each part."""
    return history.withColumn("part", _part(parts)).groupBy("part").applyInArrow(_build, INDEX)


def lookup(incoming: DataFrame, index: DataFrame, parts: int) -> DataFrame:
    """One row for each distinct digest of the history or of `incoming` (digest, winner, copies)."""
    asked = incoming.withColumn("part", _part(parts)).groupBy("part")
    return asked.cogroup(index.groupBy("part")).applyInArrow(_lookup, GROUPS)


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(parts)).cast("bigint")


def exact_dedup(docs: DataFrame, is_history: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of `docs`: id, keep_id, group_size, kept, text_sha256.

    `is_history` tells which rows are the history that the perfect hash is built over; null counts as no. Texts are equal
    when identical, null as empty. The largest id of equal texts wins, null ids last; if all are null, keep_id is null and
    none is kept. Rows that repeat id and text of the winner are all marked kept. An empty table gives no rows; other columns
    of `docs` are not read.
    """
    rows = docs.select(
        F.col(key).cast("bigint").alias("id"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("digest"),
        F.coalesce(is_history, F.lit(False)).alias("old"),
    )
    rows = written(rows, "digests")
    history = _distinct(rows.where("old"))
    parts = max(1, -(-rows.where("old").agg(F.approx_count_distinct("digest")).first()[0] // PART_DIGESTS))
    index = written(build_index(history, parts), "perfect-hash")
    groups = lookup(_distinct(rows.where("NOT old")), index, parts)
    return rows.join(groups, "digest").select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.coalesce(F.col("id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
