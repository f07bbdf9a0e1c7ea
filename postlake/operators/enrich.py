"""Joining posts to their authors.

A post names its author in `profile_id`, which equals the author profile's
`url`. Profiles hold one row per url, so a post matches at most once.

Skew: posts without an author id get a key of their own, which spreads them over
all partitions; a left join would send them to a single one. An author with a
large share of the posts is split by AQE's skew join, which cuts the hot
partition of posts into pieces and gives each its copy of that partition's
profiles. `salt` does the same by hand for a session without AQE, for all authors alike;
`enrich_unevenly` finds the authors that need it and how much, and leaves the
profiles of all others where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from postlake.schemas import DETAILED, POST


def _author(profiles: DataFrame) -> DataFrame:
    return profiles.select(
        F.col("url").alias("_author"),
        F.col("city").alias("profile_city"),
        F.col("gender").alias("profile_gender"),
        F.col("href").alias("profile_href"),
        F.col("name").alias("profile_name"),
        "reach",
        "sm_profile_id",
    )


def _spread_key() -> Column:
    return F.coalesce(F.col("profile_id"), F.concat(F.lit("\x00"), F.col("url")))


def _join(posts: DataFrame, authors: DataFrame, how: str, salt: int, strategy: str | None) -> DataFrame:
    left = posts.withColumn("_key", _spread_key())
    if strategy:
        authors = authors.hint(strategy)
    on = (F.col("_key") == F.col("_author")) & F.col("profile_id").isNotNull()
    if salt > 1:
        left = left.withColumn("_salt", F.pmod(F.xxhash64("url"), F.lit(salt)).cast("int"))
        copies = F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))
        authors = authors.withColumn("_author_salt", copies)
        on = on & (F.col("_salt") == F.col("_author_salt"))
    return left.join(authors, on, how).drop("_key", "_salt", "_author_salt")


def enrich(posts: DataFrame, profiles: DataFrame, salt: int = 1, strategy: str | None = None) -> DataFrame:
    """Posts with six author columns and `author_matched`.

    By default Spark picks the join from the sizes it measures and can always
    spill; `strategy="shuffle_hash"` asks for a hash table on the profile side.
    """
    joined = _join(posts, _author(profiles), "left", salt, strategy)
    return joined.withColumn("author_matched", F.col("_author").isNotNull()).drop("_author")


def with_author(enriched: DataFrame) -> DataFrame:
    return enriched.where("author_matched").select(*DETAILED.names)


def without_author(enriched: DataFrame) -> DataFrame:
    return enriched.where(~F.col("author_matched")).select(*POST.names)


def posts_lacking_author(posts: DataFrame, profiles: DataFrame, salt: int = 1) -> DataFrame:
    """Posts whose author has no profile, as an anti join of its own."""
    authors = profiles.select(F.col("url").alias("_author"))
    return _join(posts, authors, "left_anti", salt, None)


# Authors looked for at most; beyond as many tasks a single author's share no longer holds one up. And bytes of the profiles of
# such authors up to which every task gets all of them.
MOST_HOT = 10_000
HOT_BYTES = 64 << 20


def hot_authors(posts: DataFrame, tasks: int) -> dict[str, int]:
    """Authors with more posts than half a task's even share, and over how many tasks to spread each. Their counts come from a
    mergeable frequency sketch: one pass, combined before the shuffle, of a size that depends on `tasks` alone."""
    k = min(2 * tasks, MOST_HOT)
    found = posts.where("profile_id IS NOT NULL").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(profile_id, {k}, {max(16 * k, 64)})").alias("top")
    ).first()
    half = found["n"] / (2 * tasks)
    return {t["item"]: -(-int(t["count"]) // max(int(half), 1)) for t in found["top"] or () if t["count"] > half}


def enrich_unevenly(posts: DataFrame, profiles: DataFrame, tasks: int) -> DataFrame:
    """As `enrich`. Posts of hot authors, of whom there are few whatever the size of the tables, are joined apart: with all their
    profiles in every task, if these are measured to be small, so these posts do not move; else each author's posts spread over as
    many salts as their count asks for. The other posts meet the profiles by `profile_id`, without a shuffle of profiles that
    are bucketed by url."""
    hot = hot_authors(posts, tasks)
    if not hot:
        return enrich(posts, profiles)
    names = list(hot)
    is_hot = F.coalesce(F.col("profile_id").isin(names), F.lit(False))
    authors, many = _author(profiles.where(F.col("url").isin(names))), posts.where(is_hot)
    on = F.col("profile_id") == F.col("_author")
    if (authors.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0) <= HOT_BYTES:
        authors = F.broadcast(authors)
    else:
        schema = StructType([StructField("_hot", StringType()), StructField("_salts", IntegerType())])
        salts = posts.sparkSession.createDataFrame(list(hot.items()), schema)
        spread = F.pmod(F.xxhash64("url"), "_salts").cast("int").alias("_salt")
        many = many.join(salts, F.col("profile_id") == F.col("_hot")).select(*posts.columns, spread)
        copies = F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_author_salt")
        authors = authors.join(salts, F.col("_author") == F.col("_hot")).select(*authors.columns, copies)
        on = on & (F.col("_salt") == F.col("_author_salt"))
    joined = many.join(authors, on, "left").withColumn("author_matched", F.col("_author").isNotNull())
    return enrich(posts.where(~is_hot), profiles).unionByName(joined.drop("_author", "_salt", "_author_salt"))
