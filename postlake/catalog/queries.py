"""One query per operator, over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake import files
from postlake.catalog import records
from postlake.functions import dates, hrefs, payload, text
from postlake.operators import documents, enrich, filters, latest, layout, segments, upsert, words
from postlake.plans import cycle, export, extract, maintain, views
from postlake.plans.extract import extracted_records
from postlake.schemas import DETAILED, POST, record
from postlake.session import run_folder
from postlake.sinks.bulk import read_bulks
from postlake.sinks.extracted import read_extracted, write_extracted
from postlake.sinks.index import index_rows
from postlake.sources.cells import read_cells, readable
from postlake.sources.exports import read_export, stream_export
from postlake.sources.segments import SegmentStore
from postlake.sources.topics import FileTopics, finish
from postlake.streaming.index import publish_bulks, publish_index
from postlake.streaming.ingest import ingest_slice
from postlake.streaming.publish import publish_topics
from postlake.streaming.watch import Watch
from postlake.tables import Lake

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed dates, and the first year, that split the test tables.
ORDERS_AS_OF = "2001-08-01"
POSTS_AS_OF = "2016-08-10"
DETAILED_AS_OF = "2016-05-20"
FIRST_YEAR = 1998


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Half of the customers each, for jobs that meet the authors in two goes.
FIRST_HALF, SECOND_HALF = "c_custkey % 3 = 0", "c_custkey % 3 <> 0"


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich(records.posts(spark, sf_dir), records.profiles(spark, sf_dir))


# --- latest version per key -------------------------------------------------------


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = records.table(spark, sf_dir, "events")
    return events.select(
        F.concat(F.lit("vk://id"), F.col("user_id").cast("string")).alias("url"),
        records.millis("ts").alias("crawl_date"),
        F.col("event_type").alias("name"),
        "event_id",
        "ts",
    )


@query
def latest_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _observations(spark, sf_dir)
    return latest.latest_per_key(rows, ["url"], "ts", [F.col("event_id").desc()]).drop("ts")


@query
def top_crawls(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    rows = latest.top_per_key(_observations(spark, sf_dir), ["url"], order, 3)
    return rows.select("url", "crawl_date", "event_id")


@query
def distinct_crawls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _observations(spark, sf_dir).withColumn("day", F.to_date("ts"))
    one = latest.distinct_crawls(rows, ["url", "day"], [F.col("event_id")])
    return one.select("url", "day", "event_id")


def _new_and_saved(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Profiles crawled again, and an earlier view without one market segment."""
    base = F.lit(1470000000000)
    new = records.profiles(spark, sf_dir).select(
        "url", (base + F.floor(F.col("reach").cast("bigint") / 400)).alias("crawl_date"), "name"
    )
    saved = records.profiles(spark, sf_dir, "c_mktsegment <> 'BUILDING'").select(
        "url",
        (base + F.col("friend_count").cast("bigint")).alias("crawl_date"),
        F.concat(F.lit("saved "), F.col("name")).alias("name"),
    )
    return new, saved


@query
def conditional_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.conditional_upsert(*_new_and_saved(spark, sf_dir))


@query
def upsert_profile_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, saved = _new_and_saved(spark, sf_dir)
    return upsert.merge_newest(saved, new)


@query
def post_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest crawl of each url out of the distinct ones, and how many there are."""
    rows = _observations(spark, sf_dir).select("url", "crawl_date")
    return latest.distinct_crawls(rows, tie=[F.col("crawl_date")]).groupBy("url").agg(
        F.max("crawl_date").alias("crawl_date"), F.count(F.lit(1)).alias("crawls")
    )


# --- posts and authors ------------------------------------------------------------


@query
def post_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir)


@query
def posts_with_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_author(_enriched(spark, sf_dir))


@query
def posts_without_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.without_author(_enriched(spark, sf_dir))


@query
def posts_lacking_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.posts_lacking_author(records.posts(spark, sf_dir), records.profiles(spark, sf_dir))


@query
def retry_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts that found no author among some of the profiles, joined to the others."""
    first = enrich.enrich(records.posts(spark, sf_dir), records.profiles(spark, sf_dir, FIRST_HALF))
    return enrich.enrich(enrich.without_author(first), records.profiles(spark, sf_dir, SECOND_HALF))


@query
def clean_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.without_prefix(records.profiles(spark, sf_dir), "B", "segment")


@query
def clean_profile_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleanup job, from table to table."""
    lake = Lake(spark, run_folder(spark, "clean_profiles"))
    lake.profile.upsert(records.profiles(spark, sf_dir))
    maintain.clean_profiles(lake)
    return lake.profile_tmp.read()


@query
def href_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.repair_href(records.posts(spark, sf_dir)).select("url", "href")


# --- dates and filters ------------------------------------------------------------

PREFIX = "posts-monthly-"


@query
def index_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = records.table(spark, sf_dir, "orders")
    date = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000+0000"))
    names = orders.select(dates.index_name(PREFIX, dates.post_ts(date)).alias("index_name"))
    return names.groupBy("index_name").agg(F.count(F.lit(1)).alias("n"))


@query
def index_route_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = dates.post_ts("date")
    return records.posts(spark, sf_dir).select(
        "sm_post_id",
        F.year(dates.local_date("date")).cast("bigint").alias("local_year"),
        dates.utc_date(ts).alias("utc_date"),
        dates.index_name(PREFIX, ts).alias("index_name"),
    )


@query
def min_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = records.posts(spark, sf_dir).withColumn("post_local_date", dates.local_date("date"))
    return filters.from_year(dated, FIRST_YEAR).select("url", "date")


def _recent(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Posts within the age limit of their kind, by the extraction's own rule."""
    tagged = records.posts(spark, sf_dir).withColumns({"kind": F.lit(kind), "reason": F.lit(None).cast("string")})
    return documents.keep_recent(tagged, ORDERS_AS_OF).where(F.col("kind") == kind).select("url", "date")


@query
def recent_posts_90(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recent(spark, sf_dir, "post")


@query
def recent_posts_7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recent(spark, sf_dir, "detailed")


@query
def nonempty_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("doc_id") % 7
    body = F.when(kind == 0, None).when(kind == 1, "").when(kind == 2, " ").otherwise(F.col("text"))
    bodies = records.table(spark, sf_dir, "documents").select("doc_id", body.alias("body"))
    return filters.nonempty_body(bodies)


# --- crawl segments ---------------------------------------------------------------


@query
def segment_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = segments.union_parts(records.page_parts(spark, sf_dir))
    return rows.groupBy("part").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("url").alias("pages")
    )


@query
def status_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = segments.union_parts(records.page_parts(spark, sf_dir))
    return segments.usable(rows).select("part", "url")


@query
def segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.count_usable(segments.union_parts(records.page_parts(spark, sf_dir)))


@query
def assemble_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as fetches, labels as parse data, pages as parse texts."""

    def url(key: str) -> Column:
        return F.concat(F.lit("doc://"), F.col(key).cast("string")).alias("url")

    one = F.lit("one").alias("segment")
    docs = records.table(spark, sf_dir, "documents")
    fetch = docs.select(
        url("doc_id"), one,
        F.when(F.col("n_chars") < 500, "fetch_gone").otherwise("fetch_success").alias("status"),
        (F.lit(1470000000000) + F.col("doc_id")).alias("fetch_time"),
    )
    # The language rides along as the segment name in the metadata.
    labels = records.table(spark, sf_dir, "labels").join(docs.select("doc_id", "lang"), "doc_id")
    skip = F.when(F.col("toxic") == 1, "1").otherwise("0")
    content = F.map_from_arrays(
        F.array(F.lit("skip"), F.lit("segment")), F.array(skip, F.col("lang"))
    )
    parse_data = labels.select(
        url("doc_id"), one,
        F.when(F.col("quality") == 1, "success").otherwise("failed").alias("status"),
        content.alias("content_meta"),
        F.lit(None).cast("map<string,string>").alias("parse_meta"),
    )
    pages = records.table(spark, sf_dir, "pages")
    parse_text = pages.select(url("page_id"), one, F.col("html").alias("text"))
    return segments.assemble(fetch, parse_data, parse_text).select("url", "crawl_date", "segment", "text")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = records.page_parts(spark, sf_dir)
    fetched = parts["fetch"].unionByName(parts["parse"])
    return segments.assemble(fetched, parts["parse_data"], parts["parse_text"])


@query
def assemble_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select(
        "from_segment", "url", "crawl_date", "page_type", "route",
        F.col("text").isNotNull().alias("has_text"),
    )


@query
def unnest_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.unnest(_pages(spark, sf_dir)).select("page_url", "url", "kind")


def _extracted(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    parts = records.page_parts(spark, sf_dir)
    fetched = parts["fetch"].unionByName(parts["parse"])
    return extracted_records(fetched, parts["parse_data"], parts["parse_text"], as_of)


@query
def extract_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.demux(_extracted(spark, sf_dir, POSTS_AS_OF), "post")


@query
def extract_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.demux(_extracted(spark, sf_dir, POSTS_AS_OF), "profile")


@query
def extract_detailed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.demux(_extracted(spark, sf_dir, DETAILED_AS_OF), "detailed")


@query
def demux_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = [
        records.profiles(spark, sf_dir).withColumn("kind", F.lit("profile")),
        records.posts(spark, sf_dir).withColumn("kind", F.lit("post")),
        records.crawls(spark, sf_dir).withColumn("kind", F.lit("detailed")),
    ]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    # Fields only a detailed post has are null here.
    union = union.withColumns(
        {n: F.lit(None).cast("string") for n in DETAILED.names if n not in union.columns}
    )
    counted = [
        documents.demux(union, kind).agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
        for kind in ("profile", "post", "detailed")
    ]
    return reduce(DataFrame.unionByName, counted)


@query
def extract_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by kind, and quarantined ones by reason, of pages with several records of a kind and texts of all sorts."""
    parts = records.dirty_parts(spark, sf_dir)
    fetched = parts["fetch"].unionByName(parts["parse"])
    rows = extracted_records(fetched, parts["parse_data"], parts["parse_text"], DETAILED_AS_OF)
    return rows.groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("n"), F.sum("crawl_date").alias("crawl_sum"))


@query
def extract_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of pages that are all split before they are read, one of every 2000th conversation holding a document past any limit
    besides: that document alone is set aside."""
    parts = records.page_parts(spark, sf_dir)
    number = F.regexp_extract("url", "//([0-9]+)/1$", 1).try_cast("bigint")
    # How often depends on the row, so that tasks make the text and no plan holds it.
    is_large = number % 2000 == 0
    body = F.repeat(F.lit("0123456789abcdef"), F.when(is_large, F.lit(OVER_LIMIT)))
    opening = F.lit('[{"url":"x","contentMeta":{"type":"post"},"parseMeta":{"body":"')
    # In one go: the text is large, and so would be any part of it made before.
    filled = F.concat(opening, body, F.lit('"}},'), F.substring("text", 2, 1 << 30))
    large = F.when(is_large, filled).otherwise(F.col("text"))
    texts = parts["parse_text"].withColumn("text", large)
    fetched = parts["fetch"].unionByName(parts["parse"])
    rows = extracted_records(fetched, parts["parse_data"], texts, POSTS_AS_OF, large_bytes=1)
    return rows.where("kind IN ('post', 'quarantine')").select("url", "kind", "reason", "crawl_date", "body")


# Times 16 bytes, past what Spark's variant takes.
OVER_LIMIT = (130 << 20) // 16


def _month_store(spark: SparkSession, sf_dir: str) -> SegmentStore:
    """Orders as landing tables by month: all of them fetched, every third parsed, and some of few numbers with data and text, so that
    early and late months may lack a part."""
    root = run_folder(spark, "months")
    orders = records.table(spark, sf_dir, "orders")
    month = F.date_format("o_orderdate", "yyyy-MM").alias("segment")
    url = F.col("o_orderkey").cast("string").alias("url")
    status, time = F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("fetch_time")
    no_meta = F.lit(None).cast("map<string,string>")
    made = {
        "fetch": orders.select(url, status, time, month),
        "parse": orders.where("o_orderkey % 3 = 0").select(url, status, time, month),
        "parse_data": orders.where("o_orderkey % 101 = 0").select(url, status, no_meta.alias("content_meta"), no_meta.alias("parse_meta"), month),
        "parse_text": orders.where("o_orderkey % 5 = 0").select(url, F.col("o_orderpriority").alias("text"), month),
    }
    for name, rows in made.items():
        layout.group_for_write(rows, "segment").write.partitionBy("segment").parquet(f"{root}/{name}")
    return SegmentStore(spark, root)


def _fetched_each(store: SegmentStore, names: list[str]) -> DataFrame:
    return store.part("fetch", names).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


@query
def segment_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ends fall between two segment names; segments that lack a part are left out."""
    store = _month_store(spark, sf_dir)
    return _fetched_each(store, store.select("1996-02-15", "1997-06-15"))


@query
def single_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _month_store(spark, sf_dir)
    names = store.select(segment="1998-04")
    return store.part("fetch", names).select("segment", "url")


@query
def complete_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _month_store(spark, sf_dir)
    return _fetched_each(store, store.complete())


@query
def missing_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and orders as exports, and a third one that is not there."""
    schema = record("url", "crawl_date")
    root = run_folder(spark, "missing")
    records.profiles(spark, sf_dir).select("url", "crawl_date").write.parquet(f"{root}/profiles")
    records.posts(spark, sf_dir).select("url", "crawl_date").write.parquet(f"{root}/posts")
    found = [read_export(spark, f"{root}/{name}", schema, missing="skip") for name in ("profiles", "comments", "posts")]
    return reduce(DataFrame.unionAll, found)


@query
def spread_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.spread(records.table(spark, sf_dir, "events")).select("event_id", "event_type")


@query
def local_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.sort_locally(records.crawls(spark, sf_dir)).select("url", "crawl_date", "name")


@query
def segment_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable records of all segments, one of the values being a hash of each url."""
    rows = segments.usable(segments.union_parts(records.page_parts(spark, sf_dir)))
    return rows.agg(F.count(text.url_hash("url")).alias("records"))


@query
def extract_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing folders, a range of their segments extracted three at a time, then one by its name."""
    root = run_folder(spark, "segments")
    for name, rows in records.page_parts(spark, sf_dir).items():
        rows.write.partitionBy("segment").parquet(f"{root}/landing/{name}")
    # Segments need not have records in the parse part, but must have the part.
    for name in records.SEGMENTS:
        files.touch(spark, f"{root}/landing/parse/segment={name}/_SUCCESS")
    store = SegmentStore(spark, f"{root}/landing")
    names = extract.extract_segments(
        store, f"{root}/out", start="s2", stop="s55", batch_size=3, as_of=POSTS_AS_OF
    )
    names += extract.extract_segments(store, f"{root}/out", segment="s9", as_of=POSTS_AS_OF)
    # Twice over, the first time with another date: what was there is replaced.
    extract.extract_segments(store, f"{root}/out", segment="s3", as_of="2026-01-01")
    extract.extract_segments(store, f"{root}/out", segment="s3", as_of=POSTS_AS_OF)
    return read_extracted(spark, f"{root}/out", "post", names)


# --- JSON and text ----------------------------------------------------------------


@query
def index_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir).select("url", payload.index_json().alias("source"))


@query
def profile_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.profiles(spark, sf_dir).select("url", payload.plain_json("profile").alias("json"))


@query
def post_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.posts(spark, sf_dir).select("url", payload.plain_json("post").alias("json"))


def _through_cells(rows: DataFrame, json: Column, kind: str) -> DataFrame:
    """Rows written as JSON cells and read back."""
    spark = rows.sparkSession
    path = run_folder(spark, "cells")
    rows.select(F.col("url").alias("id"), "crawl_date", json.alias("json")).write.parquet(path)
    return readable(read_cells(spark, path, kind))


@query
def cells_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detailed posts as cells, comments under the plain keys."""
    posts = enrich.with_author(_enriched(spark, sf_dir))
    json = F.when(F.col("is_comment"), payload.plain_json("detailed")).otherwise(payload.index_json())
    return _through_cells(posts, json, "detailed")


@query
def profile_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_cells(records.profiles(spark, sf_dir), payload.plain_json("profile"), "profile")


@query
def post_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_cells(records.posts(spark, sf_dir), payload.plain_json("post"), "post")


@query
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = records.table(spark, sf_dir, "events")
    props = F.from_json("props", "map<string,bigint>")
    return events.select("event_id", text.lookup(props, "k").alias("k"))


@query
def number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = records.table(spark, sf_dir, "orders")
    whole = F.floor("o_totalprice").cast("bigint")
    json = F.concat(
        F.lit('{"whole":'), whole.cast("string"),
        F.lit('.0,"large":'), (whole * 1000003).cast("string"),
        F.lit('.0,"fraction":'), (F.col("o_orderkey") % 1000).cast("string"),
        F.lit('.05,"missing":null}'),
    )
    names = ("whole", "large", "fraction", "missing")
    parsed = orders.select("o_orderkey", F.try_parse_json(json).alias("v"))
    return parsed.select("o_orderkey", *[text.field("v", f"$.{n}").alias(n) for n in names])


@query
def row_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.posts(spark, sf_dir).select(text.row_key("url", "crawl_date").alias("row_key"))


@query
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(records.table(spark, sf_dir, "documents"))


# --- tables, streams and the cycle --------------------------------------------------


@query
def build_profile_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upsert as `upsert_profile_view`, from table to table. Every new profile
    comes twice with one crawl date; the later write counts, though it sorts lower."""
    lake = Lake(spark, run_folder(spark, "profile_view"))
    profiles = records.profiles(spark, sf_dir)
    new, saved = _new_and_saved(spark, sf_dir)
    rest = profiles.drop("crawl_date", "name")
    lake.profile.upsert(saved.join(rest, "url"))
    lake.profile_to_process.append(new.join(rest, "url").withColumn("name", F.lit("~ earlier write")))
    lake.profile_to_process.append(new.join(rest, "url"))
    views.build_profile_view(lake)
    return lake.profile.read().select("url", "crawl_date", "name")


@query
def build_post_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments come twice, the later crawl in a segment of its own; all other posts twice with one crawl date, of which
    the later write counts, though its body sorts lower."""
    lake = Lake(spark, run_folder(spark, "post_view"))
    posts = records.posts(spark, sf_dir)
    again = {"crawl_date": F.col("crawl_date") + 1, "segment": F.lit("again")}
    lake.post_to_process.append(posts.where("is_comment").withColumns(again))
    lake.post_to_process.append(posts.withColumn("body", F.lit("~ earlier write")))
    lake.post_to_process.append(posts)
    views.build_post_view(lake)
    return lake.post.read()


@query
def build_post_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both queues the join fills, from a profile table of several writes."""
    lake = Lake(spark, run_folder(spark, "post_join"))
    lake.post.upsert(records.posts(spark, sf_dir))
    profiles = records.profiles(spark, sf_dir)
    for turn in range(3):
        older = {"crawl_date": F.col("crawl_date") - 3 + turn, "name": F.lit(f"write {turn}")}
        lake.profile.upsert(profiles.where(f"friend_count % 3 >= {turn}").withColumns(older))
    lake.profile.upsert(profiles)
    views.build_post_join(lake)
    matched = lake.post_to_es.read().select("url", "profile_name", F.lit("post_to_es").alias("queue"))
    alone = lake.post_without_profile.read().select(
        "url", F.lit(None).cast("string").alias("profile_name"), F.lit("post_without_profile").alias("queue")
    )
    return matched.unionByName(alone)


@query
def repair_hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts after the repair and what it set aside; the id of some posts fits no pattern."""
    lake = Lake(spark, run_folder(spark, "repair"))
    odd = F.when(F.col("sm_post_id") % 13 == 0, F.concat(F.lit("ok://"), "sm_post_id")).otherwise(F.col("id"))
    lake.post.upsert(records.posts(spark, sf_dir).withColumn("id", odd))
    maintain.repair_hrefs(lake)
    tables = (("post", lake.post), ("unrepaired", lake.unrepaired))
    found = [table.read().select(F.lit(name).alias("table_name"), "url", "href", "body") for name, table in tables]
    return found[0].unionAll(found[1])


@query
def index_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined posts and posts that came with their author, one per url."""
    lake = Lake(spark, run_folder(spark, "index_queue"))
    posts = records.posts(spark, sf_dir)
    joined = enrich.with_author(_enriched(spark, sf_dir))
    direct = enrich.with_author(enrich.enrich(posts, records.profiles(spark, sf_dir, FIRST_HALF)))
    direct = direct.withColumn("segment", F.lit("streamed"))
    again = joined.where("is_comment").withColumns(
        {"crawl_date": F.col("crawl_date") + 1, "segment": F.lit("direct")}
    )
    lake.post_to_es.append(joined)
    lake.post_to_es.append(direct.unionByName(again))
    return lake.post_to_es.read()


@query
def export_for_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(spark, run_folder(spark, "export"))
    lake.post_to_es.append(enrich.with_author(_enriched(spark, sf_dir)))
    export.export_for_index(lake, f"{lake.root}/export")
    return spark.read.parquet(f"{lake.root}/export").select("url", "body", "post_local_date")


@query
def index_rows_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = export.exportable(enrich.with_author(_enriched(spark, sf_dir)))
    return index_rows(filters.from_year(posts, FIRST_YEAR))


QUERIES["index_rows"] = QUERIES.pop("index_rows_batch")


@query
def publish_topics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments extracted, published to topics and read back from them."""
    root = run_folder(spark, "publish")
    kinds = ("profile", "post", "detailed")
    recent = {"profile": POSTS_AS_OF, "post": POSTS_AS_OF, "detailed": DETAILED_AS_OF}
    topics = FileTopics(spark, f"{root}/topics")
    for as_of in sorted(set(recent.values())):
        kept = {kind: f"t-{kind}" for kind in kinds if recent[kind] == as_of}
        write_extracted(_extracted(spark, sf_dir, as_of), f"{root}/{as_of}", records.SEGMENTS)
        publish_topics(spark, f"{root}/{as_of}", records.SEGMENTS, topics, kept, f"{root}/checkpoint")
    sent = [topics.read(f"t-{kind}").withColumn("kind", F.lit(kind)) for kind in kinds]
    record = F.from_json("value", "url string, crawl_date bigint")
    return reduce(DataFrame.unionByName, sent).select("kind", record.alias("r")).select("kind", "r.*")


QUERIES["publish_topics"] = QUERIES.pop("publish_topics_query")


@query
def publish_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of segments that overlap and leave gaps, published one after the other under one checkpoint; each record is sent once."""
    root = run_folder(spark, "publish-again")
    topics = FileTopics(spark, f"{root}/topics")
    write_extracted(_extracted(spark, sf_dir, POSTS_AS_OF), f"{root}/out", records.SEGMENTS)
    for names in (["s1", "s5"], ["s0", "s1", "s2"], ["s2", "s9", "none"], ["s5"]):
        publish_topics(spark, f"{root}/out", names, topics, {"post": "posts"}, f"{root}/checkpoint")
    return topics.read("posts").select(F.get_json_object("value", "$.url").alias("url"))


def _send(topics: FileTopics, topic: str, rows: DataFrame) -> None:
    topics.write(rows.select(payload.message_json().alias("value")), topic)


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three kinds of topic from two tenants into the same queues, twice over, with messages that hold no record."""
    lake = Lake(spark, run_folder(spark, "ingest"))
    topics = FileTopics(spark, f"{lake.root}/topics")
    names = {"profile": ["a-profile", "b-profile"], "post": ["a-post", "b-post"], "detailed": ["b-merged"]}
    crawls, posts = records.crawls(spark, sf_dir), records.posts(spark, sf_dir)
    merged = enrich.with_author(_enriched(spark, sf_dir))
    odd = F.col("sm_profile_id").cast("bigint") % 2 == 1
    for _ in range(2):
        _send(topics, "a-profile", crawls.where(odd))
        _send(topics, "b-profile", crawls.where(~odd))
        _send(topics, "a-post", posts.where("source = 'fb'"))
        _send(topics, "b-post", posts.where("source = 'vk'"))
        _send(topics, "b-merged", merged)
        broken = crawls.where("name = 'purchase'").select(F.concat(F.lit("{broken "), "reach").alias("value"))
        topics.write(broken, "b-profile")
        ingest_slice(lake, topics, names, f"{lake.root}/checkpoint")
    queues = {"profile": lake.profile_to_process, "post": lake.post_to_process, "detailed": lake.post_to_es}
    # No row of a queue lacks the time it came in.
    missing = {kind: table.rows_beside().where("ingest_ts IS NULL").isEmpty() for kind, table in queues.items()}
    found = [
        table.read().select(F.lit(kind if missing[kind] else "unstamped").alias("queue"), "url", "crawl_date")
        for kind, table in queues.items()
    ]
    bad = lake.bad_messages.read().select(F.lit("bad").alias("queue"), F.col("message").alias("url"), F.lit(0).cast("bigint").alias("crawl_date"))
    return reduce(DataFrame.unionByName, [*found, bad])


@query
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts sent three times, twice in one slice; the queue gets each message once, before its keys would tell."""
    lake = Lake(spark, run_folder(spark, "replay"))
    topics = FileTopics(spark, f"{lake.root}/topics")
    for times in (2, 1):
        for _ in range(times):
            _send(topics, "posts", records.posts(spark, sf_dir))
        ingest_slice(lake, topics, {"post": ["posts"]}, f"{lake.root}/checkpoint", replay_window="1 hour")
    return lake.post_to_process.rows().select("url", "crawl_date")


@query
def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each topic as the running streams report them, in two slices."""
    lake = Lake(spark, run_folder(spark, "counts"))
    topics = FileTopics(spark, f"{lake.root}/topics")
    names = {"profile": ["profiles"], "post": ["fb", "vk"]}
    with Watch(spark) as watch:
        for part in ("sm_post_id % 2 = 0", "sm_post_id % 2 = 1"):
            posts = records.posts(spark, sf_dir).where(part)
            _send(topics, "fb", posts.where("source = 'fb'"))
            _send(topics, "vk", posts.where("source = 'vk'"))
            _send(topics, "profiles", records.profiles(spark, sf_dir))
            watch.settle(ingest_slice(lake, topics, names, f"{lake.root}/checkpoint"))
        counts = [(name, n) for name, n in watch.rows.items()]
    return spark.createDataFrame(counts, "name string, n long")


@query
def bulk_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export delivered in bulks by a stream of small micro-batches, as the bulks hold it; what was read lies in the archive."""
    lake = Lake(spark, run_folder(spark, "bulk"))
    root = f"{lake.root}/export"
    lake.post_to_es.append(enrich.with_author(_enriched(spark, sf_dir)))
    export.export_for_index(lake, root)
    spark.read.parquet(root).repartition(5).write.parquet(f"{lake.root}/parts")
    for _ in range(2):  # the second run finds nothing new to deliver and clears up after the first
        publish_bulks(
            spark, f"{lake.root}/parts", f"{lake.root}/bulks", f"{lake.root}/checkpoint", PREFIX, FIRST_YEAR,
            bulk_bytes=100_000, max_files=2, archive=f"{lake.root}/archive",
        )
    return read_bulks(spark, f"{lake.root}/bulks").drop("bulk")


@query
def bounded_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the files of an export are after it was read in several micro-batches: all but those of the last one in the archive."""
    root = run_folder(spark, "bounded")
    records.posts(spark, sf_dir).repartition(6).write.parquet(f"{root}/export")
    with Watch(spark) as watch:
        rows = stream_export(spark, f"{root}/export", POST, max_files=2, archive=f"{root}/archive")
        sink = rows.writeStream.queryName("bounded").format("parquet").option("path", f"{root}/out")
        running = sink.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        finish([running])
        watch.settle([running])
    if watch.batches["bounded"] < 3:
        raise RuntimeError(f"expected three micro-batches, not {watch.batches['bounded']}")
    read = spark.read.parquet(f"{root}/out").select("url", F.lit("read").alias("place"))
    archived = spark.read.option("recursiveFileLookup", "true").schema(POST).parquet(f"{root}/archive")
    left = spark.read.schema(POST).parquet(f"{root}/export")
    return read.unionAll(archived.unionAll(left).select("url", F.lit("kept").alias("place")))


@query
def stream_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(spark, run_folder(spark, "index"))
    lake.post_to_es.append(enrich.with_author(_enriched(spark, sf_dir)))
    export.export_for_index(lake, f"{lake.root}/export")
    publish_index(
        spark, f"{lake.root}/export", lake.index.put, f"{lake.root}/checkpoint", PREFIX, FIRST_YEAR
    )
    return lake.index.read()


@query
def rotate_queues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the queues after a cycle's end."""
    lake = Lake(spark, run_folder(spark, "rotate"))
    lake.profile_to_process.append(records.profiles(spark, sf_dir))
    lake.post_to_process.append(records.posts(spark, sf_dir))
    views.build_profile_view(lake)
    views.build_post_view(lake)
    views.build_post_join(lake)
    maintain.rotate_queues(lake)
    tables = {
        "post_to_process": lake.post_to_process,
        "profile_to_process": lake.profile_to_process,
        "post_to_es": lake.post_to_es,
        "post": lake.post,
        "post_without_profile": lake.post_without_profile,
    }
    sizes = [
        table.read().agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("queue"), "n")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, sizes)


@query
def cycle_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index after two cycles; some of the authors arrive with the second."""
    lake = Lake(spark, run_folder(spark, "cycle"))
    topics = FileTopics(spark, f"{lake.root}/topics")
    config = cycle.CycleConfig(
        topics=topics,
        names={"profile": ["profiles"], "post": ["posts"]},
        checkpoint=f"{lake.root}/checkpoint",
        exports=f"{lake.root}/exports",
        prefix=PREFIX,
        min_year=FIRST_YEAR,
    )
    _send(topics, "posts", records.posts(spark, sf_dir))
    _send(topics, "profiles", records.profiles(spark, sf_dir, FIRST_HALF))
    cycle.run_cycle(lake, config)
    _send(topics, "profiles", records.profiles(spark, sf_dir, SECOND_HALF))
    cycle.run_cycle(lake, config)
    return lake.index.read()
