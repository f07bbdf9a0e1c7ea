from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from build import detailed, part, posts, profiles, values
from postlake.functions.dates import local_date
from postlake.functions.text import OVERLONG
from postlake.operators import documents, enrich, filters, latest, layout, segments, upsert, words
from postlake.plans.extract import extracted_records
from postlake.schemas import DETAILED, POST
from postlake.sources.segments import batches, pick


def test_latest_breaks_ties_by_the_other_columns(spark):
    rows = profiles(
        spark,
        {"url": "a", "crawl_date": 1, "name": "old"},
        {"url": "a", "crawl_date": 2, "name": "x"},
        {"url": "a", "crawl_date": 2, "name": "y"},
        {"url": "b", "crawl_date": 5, "name": "z"},
    )
    assert values(latest.latest_per_key(rows), "url", "name") == [("a", "y"), ("b", "z")]
    assert values(latest.distinct_crawls(rows), "url", "crawl_date", "name") == [
        ("a", 1, "old"), ("a", 2, "y"), ("b", 5, "z")]
    top = latest.top_per_key(rows, ["url"], [F.col("crawl_date"), F.col("name")], 2)
    assert values(top, "url", "name") == [("a", "old"), ("a", "x"), ("b", "z")]


def test_conditional_upsert_is_strict(spark):
    new = profiles(spark, *[{"url": u, "crawl_date": 5, "name": "new"} for u in "abcd"])
    saved = profiles(
        spark, {"url": "b", "crawl_date": 4}, {"url": "c", "crawl_date": 5}, {"url": "d", "crawl_date": 6},
        {"url": "e", "crawl_date": 1},
    )
    assert values(upsert.conditional_upsert(new, saved), "url") == [("a",), ("b",)]
    merged = upsert.merge_newest(saved, new)
    assert values(merged, "url", "crawl_date", "name") == [
        ("a", 5, "new"), ("b", 5, "new"), ("c", 5, None), ("d", 6, None), ("e", 1, None)]


AUTHORS = [{"url": "vk://id1", "name": "n", "city": "c", "gender": "F", "href": "h", "reach": "3", "sm_profile_id": "1"}]
POSTS = [
    {"url": "p1", "profile_id": "vk://id1"}, {"url": "p2", "profile_id": "vk://id2"}, {"url": "p3"},
    {"url": "vk://id1", "profile_id": None},
]


@pytest.mark.parametrize("salt", [1, 4])
@pytest.mark.parametrize("strategy", [None, "shuffle_hash"])
def test_enrich(spark, salt, strategy):
    joined = enrich.enrich(posts(spark, *POSTS), profiles(spark, *AUTHORS), salt, strategy)
    assert joined.columns == [*DETAILED.names, "author_matched"]
    author = values(enrich.with_author(joined), "url", *DETAILED.names[-6:])
    assert author == [("p1", "c", "F", "h", "n", "3", "1")]
    alone = enrich.without_author(joined)
    assert alone.columns == POST.names
    assert values(alone, "url") == [("p2",), ("p3",), ("vk://id1",)]


@pytest.mark.parametrize("salt", [1, 4])
def test_posts_lacking_author(spark, salt):
    found = enrich.posts_lacking_author(posts(spark, *POSTS), profiles(spark, *AUTHORS), salt)
    assert found.columns == POST.names
    assert values(found, "url") == [("p2",), ("p3",), ("vk://id1",)]


def test_recency_excludes_the_limit_day(spark):
    rows = posts(spark, *[
        {"url": d, "date": f"{d}T00:30:00.000+0300"}
        for d in ("2016-03-03", "2016-03-04", "2016-05-25", "2016-05-26")
    ], {"url": "bad", "date": "bad"})

    def kept(kind, as_of):
        tagged = rows.withColumns({"kind": F.lit(kind), "reason": F.lit(None).cast("string")})
        return values(documents.keep_recent(tagged, as_of), "url", "kind")

    aside = ("bad", "quarantine")
    assert kept("post", dt.date(2016, 6, 1)) == [
        ("2016-03-04", "post"), ("2016-05-25", "post"), ("2016-05-26", "post"), aside]
    assert kept("detailed", "2016-06-01") == [("2016-05-26", "detailed"), aside]
    assert kept("post", None) == [aside]


def test_year_is_local(spark):
    rows = posts(
        spark, {"url": "in", "date": "2014-01-01T00:30:00+0300"}, {"url": "out", "date": "2013-12-31T23:30:00-0300"}
    ).withColumn("post_local_date", local_date("date"))
    assert values(filters.from_year(rows), "url") == [("in",)]


def test_row_filters(spark):
    rows = posts(spark, {"url": "fb://1", "body": ""}, {"url": "vk://2", "body": None}, {"url": "vk://3", "body": " "})
    assert values(filters.nonempty_body(rows), "url") == [("vk://3",)]
    assert values(filters.without_prefix(rows), "url") == [("vk://2",), ("vk://3",)]


def test_repair_href(spark):
    rows = posts(spark, {"url": "vk://id1/posts/2", "href": "x"}, {"url": "ok://1", "href": "y"})
    assert values(filters.repair_href(rows), "url", "href") == [
        ("ok://1", None), ("vk://id1/posts/2", "http://vk.com/wall1_2")]
    assert values(filters.unrepairable(rows), "url") == [("ok://1",)]


def test_word_count(spark):
    rows = spark.createDataFrame([("To be, or not to be",), ("--",), (None,)], "text string")
    assert values(words.word_count(rows)) == [("be", 2), ("not", 1), ("or", 1), ("to", 2)]


def test_layout_changes_no_rows(spark):
    rows = spark.range(100).withColumn("k", F.col("id") % 3)
    for made in (layout.spread(rows), layout.spread(rows, 5), layout.sort_locally(rows, "k"), layout.group_for_write(rows, "k")):
        assert values(made) == values(rows)
    assert layout.spread(rows, 5).rdd.getNumPartitions() == 5
    one = layout.sort_locally(rows.coalesce(1), "k").collect()
    assert [r.k for r in one] == sorted(r.k for r in one)


# --- segments ---------------------------------------------------------------------


@pytest.mark.parametrize("start, stop, expected", [
    ("s2", "s4", ["s3", "s5"]), (None, None, ["s1", "s3", "s5"]), ("s3", None, ["s3", "s5"]),
    (None, "s3", ["s1", "s3"]), ("s4", "s2", []), (None, "s9", ["s1", "s3", "s5"]), ("s6", None, []),
])
def test_segment_range(start, stop, expected):
    assert pick(["s5", "s1", "s3"], start, stop) == expected


def test_batches():
    assert list(batches(["a", "b", "c"], 2)) == [["a", "b"], ["c"]]
    assert list(batches(["a", "b"])) == [["a"], ["b"]]


def landing(spark):
    """A page of each sort, most of them holding nothing."""
    def meta(**content):
        return {"type": "post", "multiple": "true", "segment": "seg"} | content

    ok = '[{"url":"%s","contentMeta":{"type":"post"},"parseMeta":{"date":"2016-05-31T10:00:00+0300"}}]'
    pages = {
        "single": (meta(type="profile", multiple="1"), {"name": "n", "reach": "7.0"}, "ignored"),
        "single-other": (meta(multiple="false"), {}, None),
        "no-text": (meta(), {}, None),
        "empty": (meta(), {}, ""),
        "null": (meta(), {}, " null "),
        "none": (meta(), {}, "[]"),
        "skipped": (meta(skip="1"), {}, ok % "no1"),
        "not-skipped": (meta(skip="0"), {}, ok % "yes1"),
        "broken": (meta(), {}, "[{"),
        "object": (meta(), {}, "{}"),
        "bare": (meta(), {}, '[{"url":"e1"},null]'),
        "bad-date": (meta(), {}, (ok % "e2").replace("2016-05-31", "31.05.2016")),
        "old": (meta(), {}, (ok % "no2").replace("2016-05-31", "2016-01-31")),
        "mixed": (meta(type="detailed_post"), {}, """[
            {"url":"post1","contentMeta":{"type":"post"},"parseMeta":{"date":"2016-05-31T10:00:00.000+0300",
             "sm_post_id":102677859783352.0,"engagement":null,"is_comment":true,"body":"a\\nb"}},
            {"url":"profile1","contentMeta":{"type":"profile"},"parseMeta":{"name":"x","reach":1.05,
             "friend_count":"30.0","sm_profile_id":"9.0"}},
            {"url":"detailed1","contentMeta":{},"parseMeta":{"date":"2016-05-31T10:00:00+0300","reach":2630.0,
             "sm_profile_id":12345678.0,"profile_city":"c","profile_name":"p"}},
            {"url":"other","contentMeta":{"type":"album"},"parseMeta":{}}]"""),
    }
    fetch = [{"url": u, "status": "fetch_success", "fetch_time": 100} for u in pages]
    fetch += [
        {"url": "mixed", "status": "fetch_success", "fetch_time": 200},
        {"url": "failed", "status": "fetch_gone", "fetch_time": 1},
        {"url": "unparsed", "status": "fetch_success", "fetch_time": 1},
    ]
    data = [
        {"url": u, "status": "success", "content_meta": c, "parse_meta": p} for u, (c, p, _) in pages.items()
    ] + [
        {"url": "failed", "status": "success", "content_meta": meta(), "parse_meta": {}},
        {"url": "unparsed", "status": "failed", "content_meta": meta(), "parse_meta": {}},
    ]
    texts = [{"url": u, "text": t} for u, (_, _, t) in pages.items() if t is not None]
    texts += [{"url": "failed", "text": ok % "no3"}, {"url": "unparsed", "text": ok % "no4"}]
    return part(spark, "fetch", *fetch), part(spark, "parse_data", *data), part(spark, "parse_text", *texts)


def test_extraction(spark):
    records = extracted_records(*landing(spark), as_of="2016-06-01").cache()
    found = documents.demux(records, "post")
    assert values(found, "url", "sm_post_id", "engagement", "is_comment", "crawl_date", "segment") == [
        ("post1", "102677859783352", None, True, 200, "seg"), ("yes1", None, None, False, 100, "seg")]
    columns = ("url", "id", "name", "reach", "friend_count", "sm_profile_id")
    assert values(documents.demux(records, "profile"), *columns) == [
        ("profile1", "profile1", "x", "1.05", "30", "9.0"), ("single", "single", "n", "7.0", None, None)]
    assert values(documents.demux(records, "detailed"), "url", "reach", "sm_profile_id", "profile_city", "is_comment") == [
        ("detailed1", "2630", "12345678", "c", False)]
    assert values(records.where("kind = 'quarantine'"), "url", "reason") == [
        ("bare", documents.BAD_ELEMENT), ("broken", documents.NOT_JSON), ("e1", documents.BAD_ELEMENT),
        ("e2", documents.BAD_DATE), ("object", documents.NOT_JSON)]
    assert records.count() == 10


def test_strict_extraction_raises(spark):
    fetch, data, text = landing(spark)
    for page in ("broken", "object", "bare", "bad-date"):
        only = [df.where(F.col("url") == page) for df in (fetch, data, text)]
        with pytest.raises(Exception, match="no JSON array|lacks metadata|unreadable post date"):
            extracted_records(*only, as_of="2016-06-01", strict=True).collect()
    fine = [df.where(F.col("url") == "mixed") for df in (fetch, data, text)]
    assert extracted_records(*fine, as_of="2016-06-01", strict=True).count() == 3


def test_usable_records(spark):
    fetch, data, text = landing(spark)
    parts = {"fetch": fetch, "parse": fetch.where("url = 'failed'"), "parse_data": data, "parse_text": text}
    assert values(segments.count_usable(segments.union_parts(parts))) == [
        ("s1", fetch.count() - 1 + data.count() - 1 + text.count())]


def test_detailed_helper_matches_schema(spark):
    assert detailed(spark, {"url": "u"}).columns == DETAILED.names


def test_pages_too_large_to_read_say_so(spark):
    pages = spark.range(2).select(
        F.lit("s").alias("from_segment"), F.concat(F.lit("u"), "id").alias("url"), F.lit(1).cast("bigint").alias("crawl_date"),
        F.lit("s").alias("segment"), F.lit("post").alias("page_type"), F.lit("multi").alias("route"),
        F.lit(None).cast("map<string,string>").alias("parse_meta"),
        F.when(F.col("id") == 0, F.concat(F.lit('[{"url":"'), F.expr(f"repeat('x', int({150 << 20} + id))"), F.lit('"}]'))).otherwise("[").alias("text"),
    )
    assert values(documents.unnest(pages), "page_url", "reason") == [("u0", documents.TOO_LARGE), ("u1", documents.NOT_JSON)]


ELEMENTS = [
    '{"url":"a","contentMeta":{"type":"post"},"parseMeta":{"date":"d","engagement":12345678901234567890.0,"body":"q\\"[,]{ é"}}',
    '{"url":"b","contentMeta":{"type":"profile"},"parseMeta":{"reach":1.50,"name":null}}', '{"url":"c"}', "null", '"text"', "[1]", "7",
]


@pytest.mark.parametrize("text", [
    "[" + ",".join(ELEMENTS) + "]", " [ " + " , ".join(ELEMENTS[:2]) + " ] ", "[]", " [ ] ", "[{broken", "{}", "7", '["', "[" + ELEMENTS[0], "",
])
def test_split_pages_give_what_whole_ones_give(spark, text):
    schema = "from_segment string, url string, crawl_date long, segment string, page_type string, route string, parse_meta map<string,string>, text string"
    pages = spark.createDataFrame([("s", "page", 1, "s", "post", "multi", None, text)], schema)
    whole, split = (values(documents.project(documents.unnest(pages, limit))) for limit in (1 << 20, 0))
    assert split == whole


def test_no_row_carries_a_string_past_all_limits(spark):
    """It ends early as the text is read, and its element alone is set aside."""
    element = '{"url":"%s","contentMeta":{"type":"post"},"parseMeta":{"date":"2016-05-31T10:00:00+0300","body":"%s"}}'
    head, tail = ("[" + element % ("big", "|") + "," + element % ("a", "b") + "]").split("|")
    fetch, data, _ = landing(spark)
    text = F.concat(F.lit(head), F.expr(f"repeat('0123456789', int({13 << 20} + id))"), F.lit(tail))
    texts = spark.range(1).select(F.lit("s1").alias("segment"), F.lit("yes1").alias("url"), text.alias("text"))
    only = [df.where("url = 'not-skipped'").withColumn("url", F.lit("yes1")) for df in (fetch, data)]
    assert segments.assemble(*only, texts).select(F.octet_length("text")).first()[0] < 2 << 20
    found = extracted_records(*only, texts, as_of="2016-06-01").select("url", "kind", "reason", "body")
    assert values(found) == [("a", "post", None, "b"), ("yes1", "quarantine", documents.TOO_LARGE, None)]


@pytest.mark.parametrize("text, expected", [
    ('[{"url":"x","y":"@"},%s]', [("page", None, documents.TOO_LARGE), ("url1", "12345678901234567000", None)]),
    # What follows the page's array is not looked at.
    ('[%s] {"y":"@"}', [("url1", "12345678901234567891", None)]),
])
def test_an_element_with_a_string_that_ends_early_is_set_aside(spark, text, expected):
    element = '{"url":"url1","contentMeta":{"type":"post"},"parseMeta":{"sm_post_id":12345678901234567891.0}}'
    schema = "from_segment string, url string, crawl_date long, segment string, page_type string, route string, parse_meta map<string,string>, text string"
    pages = spark.createDataFrame([("s", "page", 1, "s", "post", "multi", None, text.replace("@", OVERLONG) % element)], schema)
    assert values(documents.project(documents.unnest(pages)), "url", "sm_post_id", "reason") == expected


def test_elements_beside_one_too_large_come_out(spark):
    """Their numbers too, as far as a double holds them."""
    element = '{"url":"%s","contentMeta":{"type":"post"},"parseMeta":{"date":"2016-05-31T10:00:00+0300","sm_post_id":123456789012.0,"engagement":7.25}}'
    large = F.concat(F.lit('[{"url":"big","contentMeta":{},"parseMeta":{"body":"'), F.expr(f"repeat('x', {130 << 20})"), F.lit('"}},%s,%s]' % (element % "a", element % "b")))
    pages = spark.range(1).select(
        F.lit("s").alias("from_segment"), F.lit("page").alias("url"), F.lit(1).cast("bigint").alias("crawl_date"),
        F.lit("s").alias("segment"), F.lit("post").alias("page_type"), F.lit("multi").alias("route"),
        F.lit(None).cast("map<string,string>").alias("parse_meta"), large.alias("text"),
    )
    found = documents.project(documents.unnest(pages)).select("url", "kind", "reason", "sm_post_id", "engagement")
    assert values(found) == [
        ("a", "post", None, "123456789012", "7.25"), ("b", "post", None, "123456789012", "7.25"), ("page", "quarantine", documents.TOO_LARGE, None, None)]
