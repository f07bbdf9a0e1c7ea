"""What the physical plans must look like to hold at scale."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from build import posts, profiles, values
from postlake.catalog import queries, records
from postlake.operators import enrich as enrichment
from postlake.operators import filters, latest, upsert
from postlake.operators.documents import project, unnest
from postlake.operators.enrich import enrich, posts_lacking_author
from postlake.operators.segments import assemble
from postlake.schemas import EXPORT
from postlake.plans import views
from postlake.session import co_located, fitted_shuffles, shared_folder

SF = "/root/testdata/sf0.001"


@contextmanager
def conf(spark, **values):
    values = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {"autoBroadcastJoinThreshold": "-1", "adaptive__autoBroadcastJoinThreshold": "-1"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_latest_limits_each_key_before_the_shuffle(spark):
    for rows in (
        latest.latest_per_key(records.crawls(spark, SF)),
        latest.distinct_crawls(records.crawls(spark, SF)),
        latest.top_per_key(records.crawls(spark, SF), ["url"], [F.col("crawl_date")], 5),
    ):
        text = plan(rows)
        # The tree is printed from the top down.
        assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_conditional_upsert_shuffles_each_side_once_and_reads_two_saved_columns(spark):
    with conf(spark, **NO_BROADCAST):
        new = latest.latest_per_key(records.crawls(spark, SF))
        text = plan(upsert.conditional_upsert(new, records.crawls(spark, SF)))
    assert text.count("Exchange hashpartitioning(url") == 2
    assert text.count("Exchange") == 2
    saved_scan = text[text.rindex("FileScan"):]
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in saved_scan


def test_extraction_shuffles_each_part_once(spark):
    with conf(spark, **NO_BROADCAST):
        parts = records.page_parts(spark, SF)
        pages = assemble(parts["fetch"], parts["parse_data"], parts["parse_text"])
        text = plan(project(unnest(pages)))
    assert text.count("Exchange") == 3
    assert text.count("try_parse_json") + text.count("parseJson") <= 1
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_large_pages_are_made_and_joined_in_tasks(spark):
    """Neither the plan holds a page's text, nor does the driver to broadcast it."""
    made = queries.QUERIES["extract_large"](spark, SF)
    assert len(plan(made)) < 1 << 20
    parts = records.page_parts(spark, SF)
    text = plan(assemble(parts["fetch"], parts["parse_data"], parts["parse_text"]))
    assert "SortMergeJoin" in text and "LeftOuter" in text[text.index("SortMergeJoin") :].split("\n")[0]


def test_no_query_has_a_cross_join_or_python(spark):
    batch = [
        name for name in queries.QUERIES
        if name not in ("publish_topics", "stream_ingest", "stream_index", "rotate_queues", "cycle_output",
                        "index_queue", "export_for_index", "cells_decode", "clean_profile_urls", "publish_again",
                        "stream_replay", "stream_counts", "bulk_index", "bounded_export", "segment_range",
                        "single_segment", "complete_segments", "missing_path")
    ]
    for name in batch:
        text = plan(queries.QUERIES[name](spark, SF))
        for word in ("Cartesian", "NestedLoop", "Python", "ArrowEval"):
            assert word not in text, (name, word)


def hot_posts(spark, rows=60_000):
    """A third of the posts by one author, a third without one."""
    kind = F.col("id") % 3
    author = F.when(kind == 0, "hot").when(kind == 1, F.concat(F.lit("a"), F.col("id") % 5000))
    base = posts(spark, {"url": "x"}).drop("url", "profile_id", "body")
    made = spark.range(rows).select(
        F.concat(F.lit("p"), F.col("id")).alias("url"), author.alias("profile_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("body"),
    )
    names = {f.name: F.lit(None).cast(f.dataType) for f in base.schema.fields}
    return made.select("url", "profile_id", "body", *[c.alias(n) for n, c in names.items()])


def authors(spark):
    base = profiles(spark, {"url": "x"}).drop("url")
    names = spark.range(5000).select(F.concat(F.lit("a"), F.col("id")).alias("url"))
    names = names.unionByName(spark.sql("SELECT 'hot' AS url"))
    return names.select("url", *[F.lit(None).cast(f.dataType).alias(f.name) for f in base.schema.fields])


def test_upsert_shuffles_the_new_rows_only_and_reads_their_buckets(spark, lake):
    lake.profile.put(profiles(spark, *[{"url": f"u{i}"} for i in range(100)]))
    new = profiles(spark, {"url": "u1", "crawl_date": 9})
    with conf(spark, **NO_BROADCAST), co_located(spark, lake.buckets):
        text = plan(lake.profile.merged(new))
    scan = text[text.index("FileScan"):]
    assert text.count("Exchange") == 1 and text.index("Exchange") > text.index("FileScan")
    assert "Bucketed: true" in scan and "PartitionFilters: [isnotnull(bucket" in scan.replace("IN (", "(")
    # One file for each bucket, sorted: only the new rows are sorted, and the write's own order comes on top.
    assert text.count("Sort [") == 1


def test_rows_read_from_the_buckets_go_back_without_a_shuffle_or_sort(spark, lake):
    """As the repair of links does; and the newest of a queue are shuffled once, not for the join again."""
    lake.profile.put(profiles(spark, *[{"url": f"u{i}"} for i in range(100)]))
    lake.profile_to_process.append(profiles(spark, {"url": "u1", "crawl_date": 9}))
    with conf(spark, **NO_BROADCAST), co_located(spark, lake.buckets):
        again = plan(lake.profile.merged(lake.profile.read().withColumn("name", F.lit("x"))))
        queued = plan(lake.profile.merged(lake.profile_to_process.newest("url")))
    assert again.count("Exchange") == 0 and again.count("Sort [") == 0
    assert queued.count("Exchange") == 1


@pytest.fixture
def seen(monkeypatch):
    """Plans of the rows that the author join writes, and how many rows of posts each of its tasks gives."""
    found = {}

    def watched(rows, *args):
        found["plan"] = plan(rows)
        found["tasks"] = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        return original(rows, *args)

    original = views.append_split
    monkeypatch.setattr(views, "append_split", watched)
    return found


def half_hot(spark, rows=40_000):
    base = hot_posts(spark, rows).drop("profile_id", "body")
    number = F.substring("url", 2, 9).cast("int")
    author = F.when(number % 2 == 0, "hot").otherwise(F.concat(F.lit("a"), number % 5000))
    return base.select("url", author.alias("profile_id"), F.lit("b").alias("body"), *[c for c in base.columns if c != "url"])


@pytest.mark.parametrize("most", [64 << 20, 0])
def test_profiles_stay_and_hot_authors_are_spread(spark, lake, seen, monkeypatch, most):
    """Half the posts are by one author; without AQE no task has twice the median. The profile table is of two upserts."""
    monkeypatch.setattr(enrichment, "HOT_BYTES", most)
    with conf(spark, **NO_BROADCAST, adaptive__enabled="false"):
        lake.profile.put(authors(spark).where("url < 'a3'"))
        lake.profile.put(authors(spark).where("url >= 'a2'"))
        lake.post.put(half_hot(spark))
        views.build_post_join(lake)
    cold = seen["plan"][: seen["plan"].index("hot", seen["plan"].index("FileScan"))]
    assert "Bucketed: true" in seen["plan"] and "Cartesian" not in seen["plan"] and cold
    if most:
        scans = seen["plan"].split("FileScan")
        # Posts are shuffled to the buckets, profiles are not.
        assert seen["plan"].count("Exchange hashpartitioning") == 1 and len(scans) == 5
        tasks = sorted(seen["tasks"])
        assert tasks[-1] < 2 * tasks[len(tasks) // 2]
    assert lake.post_to_es.rows().count() == 40_000 and lake.post_without_profile.rows().count() == 0
    assert values(lake.post_to_es.read().groupBy("profile_name").count())


def test_heavy_authors_are_found_and_weighed(spark):
    found = enrichment.hot_authors(half_hot(spark).where("url < 'p3'"), 8)
    assert set(found) == {"hot"} and 7 <= found["hot"] <= 9
    assert enrichment.hot_authors(half_hot(spark).where("profile_id <> 'hot'"), 8) == {}
    assert enrichment.hot_authors(half_hot(spark).limit(0), 8) == {}


@pytest.mark.parametrize("salt, share", [(1, 0.6), (16, 0.25)])
def test_posts_without_author_id_are_spread(spark, salt, share):
    with conf(spark, **NO_BROADCAST, adaptive__enabled="false", shuffle__partitions="16"):
        joined = enrich(hot_posts(spark), authors(spark), salt)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < share * 60_000
        nulls = joined.where("profile_id IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in nulls) < 0.15 * 20_000
        lacking = posts_lacking_author(hot_posts(spark), authors(spark), salt)
        assert lacking.count() == joined.where("NOT author_matched").count() == 20_000


def test_year_filter_reaches_the_scan(spark, folder):
    spark.createDataFrame([], EXPORT).write.parquet(folder)
    read = spark.read.schema(EXPORT).parquet(folder)
    assert "GreaterThanOrEqual(post_local_date,2014-01-01)" in plan(filters.from_year(read))


def test_reading_prunes_columns(spark, lake):
    lake.post.put(posts(spark, {"url": "a"}))
    text = plan(lake.post.read().select("url", "body"))
    assert "ReadSchema: struct<url:string,body:string>" in text
    assert "Exchange" not in text


def test_recency_needs_no_shuffle(spark):
    assert "Exchange" not in plan(queries.QUERIES["recent_posts_7"](spark, SF))


def test_shuffles_grow_with_the_input_and_the_session_stays(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name, None)
    with conf(spark, shuffle__partitions="8"):
        for size, count in ((1 << 40, 3 * 8192), (1 << 50, 3 * 8192 * 1024), (1 << 20, 8)):
            with fitted_shuffles(spark, size) as made:
                assert made == count and spark.conf.get(name) == str(count)
            assert spark.conf.get(name, None) == before


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
