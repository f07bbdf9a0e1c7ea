"""Mixing sources to target weights, block by block.

The words of a source stand one after another in the order of their documents and are cut into blocks of `BLOCK_WORDS`.
An output is a sequence of shards of `SHARD_SLOTS` slots. Each shard draws how many of its slots go to each source from a
multinomial whose weights are the targets; slots that a source draws beyond its quota (its target in blocks) go to the
sources that drew too few. The k-th slot of a source takes block p(k mod n) of its n blocks, p a pseudorandom permutation
of their indices, another one for each pass over them. Slots and blocks meet by index.

No row depends on how Spark deals the work: the draws are seeded by shard, the permutation by source and pass.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .words import mix, written

BLOCK_WORDS = 256
SHARD_SLOTS = 4096
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
ROUNDS = 4


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Places of indices under a Feistel permutation of 0..size-1 for each key, by cycle walking."""
    size = size.astype(np.uint64)
    half = np.maximum((np.ceil(np.log2(np.maximum(size, 2).astype(np.float64))).astype(np.int64) + 1) // 2, 1).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo].astype(np.uint64)
        left, right = out[todo] >> h, out[todo] & m
        for turn in range(ROUNDS):
            left, right = right, left ^ (mix(right * np.uint64(0x9E3779B97F4A7C15) + k + np.uint64(turn)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def sources(sized: DataFrame) -> DataFrame:
    """source, source_size, target: by code point, null last, weights repeat; the level at which all shares are dealt out is
    found from running sums over the sources, in order of the level at which each stops."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    ranked = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    stops = ranked.select(
        "source", "source_size", "rank", weight.alias("weight"),
        (F.col("source_size") * MOST_REPEATS).cast("double").alias("most"),
        F.sum("source_size").over(everything).cast("double").alias("all"),
    ).withColumn("stop", F.col("most") / F.col("weight"))
    upto = Window.orderBy("stop", "rank").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("stop", "rank").rowsBetween(0, Window.unboundedFollowing)
    # If this source and all later ones are still below their stop, the level is what the stopped ones leave, by weight.
    level = (F.col("all") - F.coalesce(F.sum("most").over(upto), F.lit(0.0))) / F.sum("weight").over(rest)
    # It holds from the first source of which that is true; counting later ones as stopped too gives lower levels.
    found = stops.withColumn("level", level).withColumn(
        "dealt", F.max(F.when(F.col("level") <= F.col("stop"), F.col("level"))).over(everything)
    )
    return found.select(
        "source", "source_size", "rank",
        F.least("most", F.coalesce("dealt", F.lit(0.0)) * F.col("weight")).alias("target"),
    )


def stretches(sized: DataFrame) -> DataFrame:
    """Adds `start`, the words of the source before each document.

    Rows are dealt by ranges of (source, id); sums of the ranges give where each begins, so no task holds a whole source.
    """
    order = [F.col("source").asc_nulls_first(), F.col("id").asc_nulls_first(), "tie"]
    ranged = written(sized.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "mix-ranges")
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("here"))
    before = F.sum("here").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(F.col("source").alias("s"), F.col("range").alias("r"), F.coalesce(before, F.lit(0)).alias("before"))
    within = F.sum("size").over(
        Window.partitionBy("source", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = ranged.withColumn("within", F.coalesce(within, F.lit(0)))
    return inside.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))).select(
        "id", "tie", "source", "size", (F.col("before") + F.col("within")).alias("start")
    )


def _quotas(plan: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of each source, and the slots that bring its words nearest to its target."""
    size = plan["source_size"].to_numpy(np.int64)
    blocks = -(-size // BLOCK_WORDS)
    ratio = np.divide(plan["target"].to_numpy(np.float64), size, out=np.zeros(len(size)), where=size > 0)
    return blocks, np.minimum(np.rint(ratio * blocks).astype(np.int64), MOST_REPEATS * blocks)


def slots(spark: SparkSession, plan: pd.DataFrame, seed: int) -> DataFrame:
    """shard, slot, rank, ordinal, block: what each slot of the output takes. `plan`: a row for each source, by rank."""
    blocks, quota = _quotas(plan)
    total = int(quota.sum())
    shards = -(-total // SHARD_SLOTS)
    share = quota / max(total, 1)

    def draws(shard: int) -> np.ndarray:
        n = min(SHARD_SLOTS, total - shard * SHARD_SLOTS)
        return np.random.default_rng([seed, shard]).multinomial(n, share)

    def drawn(frames):
        for frame in frames:
            for shard in frame["id"]:
                yield pd.DataFrame({"shard": shard, "rank": np.arange(len(share)), "n": draws(int(shard))})

    def dealt(own):
        own = own.sort_values("rank")
        n, first = own["n"].to_numpy(np.int64), own["first"].to_numpy(np.int64)
        rank = np.repeat(own["rank"].to_numpy(np.int64), n)
        ordinal = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        # Surplus draws, numbered through over all sources, fill up what the sources lack, also numbered through.
        beyond = ordinal >= quota[rank]
        nth = begins[rank[beyond]] + ordinal[beyond] - quota[rank[beyond]]
        to = np.searchsorted(short, nth, side="right")
        rank[beyond], ordinal[beyond] = to, filled[to] + nth - (short[to] - lacking[to])
        size = blocks[rank]
        key = mix(np.uint64(seed) + rank.astype(np.uint64) * np.uint64(1_000_003) + (ordinal // size).astype(np.uint64))
        return pd.DataFrame({
            "shard": own["shard"].iloc[0], "slot": np.arange(len(rank)), "rank": rank, "ordinal": ordinal,
            "block": permuted(ordinal % size, size, key),
        })

    counts = written(spark.range(shards).mapInPandas(drawn, "shard bigint, rank bigint, n bigint"), "mix-draws")
    by_rank = {r["rank"]: r["n"] for r in counts.groupBy("rank").agg(F.sum("n").alias("n")).collect()}
    got = np.array([by_rank.get(i, 0) for i in range(len(share))], np.int64)
    lacking, filled = np.maximum(quota - got, 0), np.minimum(got, quota)
    short = np.cumsum(lacking)
    begins = np.cumsum(np.maximum(got - quota, 0)) - np.maximum(got - quota, 0)
    # Ordinals of a shard begin after those of the earlier shards: one running sum for each source over its shards' counts.
    before = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    numbered = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).where("n > 0")
    return numbered.groupBy("shard").applyInPandas(
        dealt, "shard bigint, slot bigint, rank bigint, ordinal bigint, block bigint"
    )


def block_parts(placed: DataFrame) -> DataFrame:
    """rank, block, row, id, from, words: the stretch of each document that lies in each block, and the word of the document
    it begins with. Joined with `slots` by (rank, block), these rows are the mixed output."""
    end = F.col("start") + F.col("size")
    block = F.explode(F.sequence(F.floor(F.col("start") / BLOCK_WORDS), F.floor((end - 1) / BLOCK_WORDS)))
    cut = placed.where("size > 0").withColumn("block", block)
    begins = F.greatest(F.col("start"), F.col("block") * BLOCK_WORDS)
    ends = F.least(end, (F.col("block") + 1) * BLOCK_WORDS)
    return cut.select("rank", "block", "row", "id", (begins - F.col("start")).alias("from"), (ends - begins).alias("words"))


def mix_sources(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 8) -> DataFrame:
    """One row for each row of `docs`: doc_id, size, source_size, target, taken.

    Sizes are numbers of words `[^\\x20\\x09-\\x0D]+`, null texts have none. Null sources form a source of their own, ranked
    last. Documents of a source follow each other by id, null ids first, equal ids by a hash of the text; rows that repeat id
    and text may swap their `taken`. Sources and documents without words take nothing. The number of sources is what the
    driver sees, never documents. Other columns of `docs` are not read.
    """
    sized = docs.select(
        F.col(key).cast("bigint").alias("id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tie"),
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint").alias("size"),
    )
    placed = written(stretches(written(sized, "mix-sized")), "mix-placed")
    plan = written(sources(placed), "mix-sources")
    spark = docs.sparkSession
    shares = plan.orderBy("rank").toPandas()
    named = plan.select(F.col("source").alias("s"), "rank", "source_size", "target")
    placed = placed.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("row", F.monotonically_increasing_id())
    placed = written(placed, "mix-rows")
    times = slots(spark, shares, seed).groupBy("rank", "block").agg(F.count(F.lit(1)).alias("times"))
    # Slots grow with the corpus, which their estimated size does not show: neither side is broadcast.
    took = block_parts(placed).join(times.hint("shuffle_merge"), ["rank", "block"]).groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    return placed.join(took, "row", "left").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")
    )

