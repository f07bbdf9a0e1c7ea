"""Operators over the parts of crawl segments."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.text import lookup, without_overlong
from postlake.operators.latest import top_per_key
from postlake.schemas import FETCHED, META_MULTIPLE, META_SEGMENT, META_SKIP, META_TYPE, PARSED, SEGMENT_PARTS


def union_parts(parts: dict[str, DataFrame]) -> DataFrame:
    """All parts as one dataset, told apart by `part`."""
    tagged = [df.withColumn("part", F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def usable(records: DataFrame) -> DataFrame:
    """Successful fetches, successful parse data, and every parse text."""
    part, status = F.col("part"), F.col("status")
    return records.where(
        (part.isin("fetch", "parse") & (status == FETCHED))
        | ((part == "parse_data") & (status == PARSED))
        | (part == "parse_text")
    )


def count_usable(records: DataFrame) -> DataFrame:
    """Number of usable records in each segment."""
    return usable(records).groupBy("segment").agg(F.count(F.lit(1)).alias("records"))


def _one_per_page(df: DataFrame, *order: Column) -> DataFrame:
    return top_per_key(df, ["segment", "url"], list(order))


def assemble(fetch: DataFrame, parse_data: DataFrame, parse_text: DataFrame) -> DataFrame:
    """One row per page: its fetch and parse data, with its text if there is any.

    Failed records, pages missing either of the first two and pages flagged to be
    skipped are dropped. Several records of a kind come down to one: the latest
    fetch, or one picked by value. The joins reuse the partitioning by segment
    and url that this needs, so each part is shuffled once. Texts are never
    broadcast: what Spark takes for their size says nothing of it, and the driver
    would hold them all. Strings too long for any reader are cut where a text is
    read, so that no row carries them: every buffer for rows takes up to twice the
    size of a text that goes through it.
    """
    fetched = _one_per_page(
        fetch.where(F.col("status") == FETCHED).select("segment", "url", "fetch_time"),
        F.col("fetch_time").desc_nulls_last(),
    )
    parsed = _one_per_page(
        parse_data.where(F.col("status") == PARSED).select("segment", "url", "content_meta", "parse_meta"),
        F.xxhash64(F.map_entries("content_meta"), F.map_entries("parse_meta")),
    ).where(F.coalesce(lookup("content_meta", META_SKIP), F.lit("")) != "1")
    texts = _one_per_page(
        parse_text.select("segment", "url", without_overlong("text").alias("text")), F.col("text").desc_nulls_last()
    )
    pages = fetched.join(parsed, ["segment", "url"]).join(texts.hint("merge"), ["segment", "url"], "left")
    return pages.select(
        F.col("segment").alias("from_segment"),
        "url",
        F.col("fetch_time").alias("crawl_date"),
        lookup("content_meta", META_SEGMENT).alias("segment"),
        lookup("content_meta", META_TYPE).alias("page_type"),
        route().alias("route"),
        "parse_meta",
        "text",
    )


def route() -> Column:
    """`multi` for a page flagged as holding several documents, else `single`."""
    multiple = F.coalesce(lookup("content_meta", META_MULTIPLE), F.lit("")) == "true"
    return F.when(multiple, F.lit("multi")).otherwise(F.lit("single"))
