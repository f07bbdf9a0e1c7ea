from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from build import posts, profiles, values
from postlake import files, tables
from postlake.operators.enrich import enrich, with_author, without_author
from postlake.plans import maintain, views
from postlake.session import run_folder
from postlake.tables import Lake, append_split, rotate

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def files_of(spark, table):
    return {path.rsplit("/", 2)[1]: path for path in files.matching(spark, f"{table.path}/bucket=*/part-*")}


def test_upsert_keeps_the_newest(spark, lake):
    assert lake.profile.read().count() == 0
    lake.profile.put(profiles(spark, {"url": "a", "crawl_date": 2, "name": "1"}, {"url": "b", "name": "1"}))
    lake.profile.put(profiles(spark, {"url": "a", "crawl_date": 1, "name": "2"}, {"url": "c", "name": "2"}))
    lake.profile.put(profiles(spark, {"url": "b", "crawl_date": 9, "name": "3"}, {"url": "c", "name": "3"}))
    expected = [("a", 2, "1"), ("b", 9, "3"), ("c", 1, "2")]
    assert values(lake.profile.read(), "url", "crawl_date", "name") == expected


def test_ties_go_to_the_later_write_where_nothing_says_otherwise(spark, lake):
    for name in "xba":
        lake.profile_tmp.put(profiles(spark, {"url": "u", "name": name}))
        lake.profile.put(profiles(spark, {"url": "u", "name": name}))
        lake.profile_to_process.append(profiles(spark, {"url": "u", "name": name}))
    assert values(lake.profile_tmp.read(), "name") == [("a",)]
    assert values(lake.profile.read(), "name") == [("x",)]
    assert values(lake.profile_to_process.read(), "name") == [("a",)]


def test_rows_without_a_date_give_way(spark, lake):
    for table, kept in ((lake.profile, ["x", "x", "z", "z"]), (lake.profile_tmp, ["x", "y", "z", "z"])):
        for (date, name), left in zip([(None, "x"), (None, "y"), (5, "z"), (None, "w")], kept):
            table.put(profiles(spark, {"url": "u", "crawl_date": date, "name": name}))
            assert values(table.read(), "name") == [(left,)]


def test_history_keeps_every_crawl(spark, lake):
    rows = profiles(spark, {"url": "a", "crawl_date": 1}, {"url": "a", "crawl_date": 2})
    lake.profile_to_process.append(rows)
    lake.profile_to_process.append(rows)
    assert values(lake.profile_to_process.read(), "url", "crawl_date") == [("a", 1), ("a", 2)]
    assert lake.profile_to_process.rows().count() == 4


def test_an_upsert_writes_only_the_buckets_of_its_keys(spark, lake):
    table = lake.profile
    table.put(profiles(spark, *[{"url": f"u{i}"} for i in range(200)]))
    before = files_of(spark, table)
    assert len(before) == lake.buckets  # one file each
    new = profiles(spark, {"url": "u3", "crawl_date": 9, "name": "new"}, {"url": "v1"})
    touched = {f"bucket={r[0]}" for r in new.select(table.bucket()).collect()}
    table.put(new)
    after = files_of(spark, table)
    assert {b for b in after if after[b] != before.get(b)} == touched and len(touched) < lake.buckets
    assert table.read().count() == 201 and values(table.read().where("url = 'u3'"), "name") == [("new",)]
    table.put(new.limit(0))
    assert files_of(spark, table) == after


def test_a_table_is_found_by_another_session(spark, lake):
    lake.profile.put(profiles(spark, *[{"url": f"u{i}"} for i in range(20)]))
    other = Lake(spark.newSession(), lake.root)
    spark.sql(f"DROP TABLE {lake.profile.table()}")
    assert other.profile.read().count() == 20
    other.profile.put(profiles(other.spark, {"url": "z"}))
    assert lake.profile.read().count() == 21


def test_null_keys_are_an_error(spark, lake):
    with pytest.raises(Exception, match="a row without url"):
        lake.profile.put(profiles(spark, {"url": None}))


def test_truncate(spark, lake):
    lake.profile.put(profiles(spark, {"url": "a"}, {"url": "b"}))
    lake.profile.truncate()
    assert lake.profile.read().count() == 0 and files.matching(spark, lake.profile.path) == []
    lake.profile.put(profiles(spark, {"url": "a"}, {"url": "a"}))
    assert values(lake.profile.read(), "url") == [("a",)]
    lake.profile_to_process.append(profiles(spark, {"url": "a"}))
    lake.profile_to_process.replace(profiles(spark, {"url": "b"}))
    assert values(lake.profile_to_process.read(), "url") == [("b",)]
    lake.profile_to_process.truncate()
    assert lake.profile_to_process.read().count() == 0


def test_a_failed_write_leaves_the_table_as_it_was(spark, lake):
    lake.profile.put(profiles(spark, {"url": "a"}, {"url": "b"}))
    failing = profiles(spark, {"url": "a", "crawl_date": 9}).withColumn("name", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        lake.profile.put(failing)
    assert values(lake.profile.read(), "url", "crawl_date") == [("a", 1), ("b", 1)]


def test_buckets_double_until_one_is_small(spark, lake, monkeypatch):
    """Whatever their number, each bucket is one file, and a failed upsert that would have grown the table leaves it as it was."""
    monkeypatch.setattr(tables, "BUCKET_BYTES", 4000)
    table = lake.profile
    table.put(profiles(spark, *[{"url": f"u{i}"} for i in range(100)]))
    assert table.count() == lake.buckets and len(files_of(spark, table)) == lake.buckets
    many = profiles(spark, *[{"url": f"u{i}", "crawl_date": 2, "name": "new"} for i in range(50, 1000)])
    with pytest.raises(Exception, match="no"):
        table.put(many.withColumn("name", F.raise_error(F.lit("no")).cast("string")))
    assert table.count() == lake.buckets and table.read().count() == 100
    table.put(many)
    grown = table.count()
    assert grown >= 4 * lake.buckets and table.read().count() == 1000 and table.read().where("name = 'new'").count() == 950
    assert files_of(spark, table) == {}
    assert len(files.matching(spark, f"{table.path}/grown-{grown}/bucket=*/part-*")) == grown
    other = Lake(spark.newSession(), lake.root)
    spark.sql(f"DROP TABLE {table.table()}")
    monkeypatch.undo()
    other.profile.put(profiles(other.spark, {"url": "z"}, {"url": "u1", "crawl_date": 3}))
    assert table.count() == grown and table.read().count() == 1001
    table.truncate()
    assert table.count() == lake.buckets and table.read().count() == 0


def test_the_join_of_posts_takes_as_many_tasks_as_they_need(spark, lake, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_BYTES", 4000)
    tasks = []
    monkeypatch.setattr(views, "enrich_unevenly", lambda posts, authors, n: tasks.append(n) or enrich(posts, authors))
    lake.profile.put(profiles(spark, {"url": "x", "name": "n"}))
    lake.post.put(posts(spark, *[{"url": f"u{i}", "profile_id": "x" if i % 2 else None} for i in range(500)]))
    views.build_post_join(lake)
    assert tasks[0] > lake.profile.count() == lake.buckets
    assert lake.post_to_es.read().count() == lake.post_without_profile.read().count() == 250


def test_index_table_is_keyed_by_index_and_id(spark, lake):
    schema = "index_name string, _id string, source string"
    lake.index.put(spark.createDataFrame([("m1", "a", "1"), ("m2", "a", "2")], schema))
    lake.index.put(spark.createDataFrame([("m1", "a", "3"), ("m1", "b", "4")], schema))
    assert values(lake.index.read()) == [("m1", "a", "3"), ("m1", "b", "4"), ("m2", "a", "2")]


def test_queues_of_one_root_are_apart(spark, lake):
    rows = posts(spark, {"url": "a"}, {"url": "b", "crawl_date": 5})
    joined = enrich(rows.withColumn("profile_id", F.when(F.col("url") == "a", "x")), profiles(spark, {"url": "x"}))
    append_split(joined, "author_matched", lake.post_to_es.path)
    lake.post_to_es.append(with_author(joined).withColumn("url", F.lit("c")))
    assert values(lake.post_to_es.read(), "url") == [("a",), ("c",)]
    lake.post_to_es.truncate()
    assert values(lake.post_without_profile.read(), "url") == [("b",)] and lake.post_to_es.read().count() == 0


def test_rotate_writes_the_target_before_it_empties_the_source(spark, lake):
    lake.post_without_profile.append(posts(spark, {"url": "a"}, {"url": "b", "crawl_date": 5}))
    lake.post_to_process.append(posts(spark, {"url": "z"}))
    rotate(lake.post_without_profile, lake.post_to_process, F.col("crawl_date") >= 5)
    assert values(lake.post_to_process.read(), "url") == [("b",)]
    assert lake.post_without_profile.read().count() == 0


observations = st.lists(
    st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.sampled_from("xyz")), min_size=1, max_size=12
)


def rows_of(spark, seen):
    return profiles(spark, *[{"url": u, "crawl_date": d, "name": n} for u, d, n in seen])


@FEW
@given(observations)
def test_upsert_twice_is_upsert_once(spark, seen):
    lake = Lake(spark, run_folder(spark, "test"))
    lake.profile.put(rows_of(spark, seen))
    once = values(lake.profile.read())
    lake.profile.put(rows_of(spark, seen))
    assert values(lake.profile.read()) == once


@FEW
@given(observations, observations)
def test_order_of_upserts_does_not_matter_for_the_date(spark, first, second):
    results = []
    for pair in ((first, second), (second, first)):
        lake = Lake(spark, run_folder(spark, "test"))
        for seen in pair:
            lake.profile.put(rows_of(spark, seen))
        results.append(values(lake.profile.read(), "url", "crawl_date"))
    newest = {u: max(d for v, d, _ in first + second if v == u) for u, _, _ in first + second}
    assert results == [sorted(newest.items())] * 2


@FEW
@given(observations, observations)
def test_profile_view_equals_the_rule_applied_row_by_row(spark, saved, new):
    lake = Lake(spark, run_folder(spark, "test"))
    lake.profile.put(rows_of(spark, saved))
    before = {r.url: (r.crawl_date, r.name) for r in lake.profile.read().collect()}
    lake.profile_to_process.append(rows_of(spark, new))
    views.build_profile_view(lake)
    after = {r.url: (r.crawl_date, r.name) for r in lake.profile.read().collect()}
    for url in before.keys() | {u for u, _, _ in new}:
        best = max(((d, n) for u, d, n in new if u == url), default=None)
        if url not in before or (best and best[0] > before[url][0]):
            assert after[url] == best
        else:
            assert after[url] == before[url]


@FEW
@given(st.lists(st.tuples(st.integers(0, 50), st.sampled_from(["a", "b", "c", None])), max_size=12, unique_by=lambda t: t[0]))
def test_matched_and_unmatched_make_up_the_posts(spark, seen):
    made = posts(spark, {"url": "always"}, *[{"url": f"p{i}", "profile_id": a} for i, a in seen])
    joined = enrich(made, profiles(spark, {"url": "a"}, {"url": "b"}))
    found = values(with_author(joined), "url") + values(without_author(joined), "url")
    assert sorted(found) == values(made, "url")


def test_view_jobs(spark, lake):
    lake.post_to_process.append(posts(
        spark, {"url": "p", "crawl_date": 1, "body": "old"}, {"url": "p", "crawl_date": 3, "body": "new"},
        {"url": "q", "profile_id": "a"},
    ))
    lake.profile_to_process.append(profiles(spark, {"url": "a", "city": "c"}))
    views.build_profile_view(lake)
    views.build_post_view(lake)
    views.build_post_join(lake)
    assert values(lake.post.read(), "url", "body") == [("p", "new"), ("q", "text")]
    assert values(lake.post_to_es.read(), "url", "profile_city") == [("q", "c")]
    assert values(lake.post_without_profile.read(), "url") == [("p",)]
    maintain.rotate_queues(lake)
    assert values(lake.post_to_process.read(), "url", "body") == [("p", "new")]
    for table in (lake.post, lake.post_to_es, lake.post_without_profile, lake.profile_to_process):
        assert table.read().count() == 0
    assert lake.profile.read().count() == 1


def test_retry_age_limit(spark, lake):
    lake.post_without_profile.append(posts(spark, {"url": "old", "crawl_date": 10}, {"url": "new", "crawl_date": 95}))
    maintain.rotate_queues(lake, max_age_ms=10, now_ms=100)
    assert values(lake.post_to_process.read(), "url") == [("new",)]


def test_maintenance_jobs(spark, lake):
    lake.profile.put(profiles(spark, {"url": "fb://1"}, {"url": "vk://id1"}))
    maintain.clean_profiles(lake)
    assert values(lake.profile_tmp.read(), "url") == [("vk://id1",)]
    lake.post.put(posts(
        spark, {"url": "vk://id1/posts/2", "href": "x"}, {"url": "ok://1", "href": "y"},
        {"url": "vk://id1/posts/3", "href": "http://vk.com/wall1_3"},
    ))
    maintain.repair_hrefs(lake)
    assert values(lake.unrepaired.read(), "url", "href") == [("ok://1", "y")]
    assert values(lake.post.read(), "url", "href") == [
        ("ok://1", "y"), ("vk://id1/posts/2", "http://vk.com/wall1_2"), ("vk://id1/posts/3", "http://vk.com/wall1_3")]
    with pytest.raises(Exception, match="no link for id"):
        maintain.repair_hrefs(lake, strict=True)
    assert lake.post.read().count() == 3


writes = st.lists(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 1), st.sampled_from("xyz")), min_size=1, max_size=4), min_size=1, max_size=4)


@FEW
@given(writes)
def test_views_of_a_queue_are_views_of_what_it_reads(spark, seen):
    """Later writes win within a url and crawl date, in the views as in the queue."""
    lake = Lake(spark, run_folder(spark, "test"))
    for rows in seen:
        lake.profile_to_process.append(rows_of(spark, rows))
        lake.post_to_process.append(posts(spark, *[{"url": u, "crawl_date": d, "body": n} for u, d, n in rows]))
    for queue, view, column in ((lake.profile_to_process, lake.profile, "name"), (lake.post_to_process, lake.post, "body")):
        newest = {}
        for r in queue.read().collect():
            newest[r["url"]] = max(newest.get(r["url"], (-1, "")), (r["crawl_date"], r[column]))
        (views.build_profile_view if view is lake.profile or column == "name" else views.build_post_view)(lake)
        assert {r["url"]: (r["crawl_date"], r[column]) for r in view.read().collect()} == newest


def test_views_with_a_profile_table_larger_than_the_queues(spark, lake):
    saved = [{"url": f"a{i}", "crawl_date": 5, "name": f"n{i}"} for i in range(500)]
    lake.profile.put(profiles(spark, *saved[:250]))
    lake.profile.put(profiles(spark, *saved[200:]))
    lake.profile_to_process.append(profiles(
        spark, {"url": "a1", "crawl_date": 5}, {"url": "a2", "crawl_date": 6, "name": "new"}, {"url": "b"}))
    lake.post_to_process.append(posts(
        spark, {"url": "p1", "profile_id": "a2"}, {"url": "p2", "profile_id": "a499"}, {"url": "p3", "profile_id": "z"}))
    views.build_profile_view(lake)
    assert lake.profile.read().count() == 501
    views.build_post_view(lake)
    views.build_post_join(lake)
    assert values(lake.post_to_es.read(), "url", "profile_name") == [("p1", "new"), ("p2", "n499")]
    assert values(lake.post_without_profile.read(), "url") == [("p3",)]
