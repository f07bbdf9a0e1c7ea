"""The test tables seen as the engine's own records.

Customers are profiles, orders are posts written by them, conversations are
pages that hold several documents, documents and labels are crawl records, and
events are crawl observations of a url. Every function reads its whole table.
`oracle.py` states the same mapping in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.schemas import POST, PROFILE
from postlake.session import tune


# The schemas of the test tables, so that no file is opened to infer one.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def millis(ts: str) -> Column:
    """Epoch milliseconds of a zoneless timestamp, read as UTC."""
    return F.unix_millis(F.col(ts).cast("timestamp"))


PROFILE_OF_CUSTOMER = {
    "url": "concat(if(c_custkey % 2 = 0, 'fb://', 'vk://id'), c_custkey)",
    "crawl_date": "1470000000000 + c_custkey",
    "id": "concat(if(c_custkey % 2 = 0, 'fb://', 'vk://id'), c_custkey)",
    "segment": "c_mktsegment",
    "href": "concat(if(c_custkey % 2 = 0, 'https://www.facebook.com/', 'http://vk.com/id'), c_custkey)",
    "source": "if(c_custkey % 2 = 0, 'fb', 'vk')",
    "sm_profile_id": "cast(c_custkey AS string)",
    "name": "c_name",
    "city": "n_name",
    "reach": "cast(floor(c_acctbal) AS string)",
    "friend_count": "cast(c_nationkey AS string)",
    "follower_count": "cast(NULL AS string)",
    "gender": "CASE c_nationkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END",
}


def profiles(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    customer = table(spark, sf_dir, "customer").where(where)
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.selectExpr(*[f"{PROFILE_OF_CUSTOMER[n]} AS {n}" for n in PROFILE.names])


# One of four forms: post or comment, on either network.
_AUTHOR = "concat(if(o_custkey % 2 = 0, 'fb://', 'vk://id'), o_custkey)"
_URL = """concat(
    if(o_custkey % 2 = 0, concat('fb://', o_custkey, '/posts/', o_custkey, '_', o_orderkey),
       concat('vk://id', o_custkey, '/posts/', o_orderkey)),
    CASE WHEN o_orderkey % 2 = 0 THEN '' WHEN o_custkey % 2 = 0
         THEN concat('/comments/', o_orderkey, '_', o_orderkey + 1)
         ELSE concat('/comments/', o_orderkey + 1) END)"""

POST_OF_ORDER = {
    "url": _URL,
    "crawl_date": "unix_millis(cast(o_orderdate AS timestamp)) + 86400000",
    "id": _URL,
    "segment": "date_format(o_orderdate, 'yyyyMM')",
    "href": "concat('http://old.example/', o_orderkey)",
    "source": "if(o_custkey % 2 = 0, 'fb', 'vk')",
    # Some posts name no author, some one that no profile is of.
    "profile_id": f"CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN concat({_AUTHOR}, '0x') "
    f"ELSE {_AUTHOR} END",
    "sm_post_id": "cast(o_orderkey AS string)",
    "parent_post_id": f"if(o_orderkey % 2 = 1, concat({_AUTHOR}, '/posts/', o_orderkey), NULL)",
    "body": "CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' "
    "ELSE concat_ws(' ', o_orderpriority, o_orderstatus) END",
    "date": "concat(date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\"), '.000+0300')",
    "engagement": "cast(floor(o_totalprice) AS string)",
    "is_comment": "o_orderkey % 2 = 1",
}


def posts(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(where)
    return orders.selectExpr(*[f"{POST_OF_ORDER[n]} AS {n}" for n in POST.names])


def crawls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile observations: several crawls of each user's url."""
    events = table(spark, sf_dir, "events")
    url = F.concat(F.lit("vk://id"), _text("user_id"))
    columns = {name: F.lit(None).cast("string") for name in PROFILE.names}
    columns |= {
        "url": url,
        "crawl_date": millis("ts"),
        "id": url,
        "segment": F.date_format("ts", "yyyyMMdd"),
        "source": F.lit("vk"),
        "sm_profile_id": _text("user_id"),
        "name": F.col("event_type"),
        "reach": _text("event_id"),
    }
    return events.select(*[columns[n].alias(n) for n in PROFILE.names])


# --- crawl segments -------------------------------------------------------------

SEGMENTS = [f"s{i}" for i in range(10)]


def _json_element(kind: str | None, url: Column, meta: dict[str, Column]) -> Column:
    content = F.struct((F.lit(kind) if kind else F.lit(None).cast("string")).alias("type"))
    return F.to_json(
        F.struct(
            url.alias("url"),
            content.alias("contentMeta"),
            F.struct(*[v.alias(k) for k, v in meta.items()]).alias("parseMeta"),
        )
    )


def page_parts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Landing tables made of conversations: one page per turn.

    Turns said by the system are single-document profile pages. All others are
    multi-document pages of a post, a profile and a detailed post without a type
    of its own, which takes the type of the page. Very short turns failed to fetch,
    very long ones to parse, and some in between are flagged to be skipped.
    """
    turns = table(spark, sf_dir, "conversations")
    key = F.concat(_text("conv_id"), F.lit("/"), _text("turn"))
    url = F.concat(F.lit("page://"), key)
    length = F.length("text")
    segment = F.concat(F.lit("s"), F.col("conv_id") % 10)
    is_single = F.col("role") == "system"

    fetch = turns.select(
        url.alias("url"),
        F.when(length < 70, "fetch_gone").otherwise("fetch_success").alias("status"),
        (F.lit(1470000000000) + F.col("conv_id") * 1000 + F.col("turn")).alias("fetch_time"),
        segment.alias("segment"),
    )
    content_meta = F.map_from_arrays(
        F.array(*[F.lit(k) for k in ("type", "skip", "multiple", "segment")]),
        F.array(
            F.when(is_single, "profile").otherwise("detailed_post"),
            F.when(length.between(250, 300), "1").otherwise("0"),
            F.when(is_single, "false").otherwise("true"),
            segment,
        ),
    )
    parse_meta = F.map_from_arrays(
        F.array(*[F.lit(k) for k in ("href", "source", "sm_profile_id", "name", "reach")]),
        F.array(F.concat(F.lit("http://"), key), F.lit("vk"), _text("conv_id"), F.col("role"), F.lit("7.0")),
    )
    parse_data = turns.select(
        url.alias("url"),
        F.when(length > 1400, "failed").otherwise("success").alias("status"),
        content_meta.alias("content_meta"),
        parse_meta.alias("parse_meta"),
        segment.alias("segment"),
    )
    day = F.date_add(F.lit("2016-05-01").cast("date"), (F.col("conv_id") % 20).cast("int"))
    meta = {
        "href": F.concat(F.lit("http://"), key),
        "source": F.lit("vk"),
        "profile_id": F.concat(F.lit("vk://id"), _text("conv_id")),
        "sm_post_id": F.col("conv_id").cast("decimal(20,1)"),
        "body": F.col("text"),
        "date": F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:30:00.000+0300")),
        "engagement": (F.col("turn") * 1000000).cast("decimal(20,1)"),
    }
    post = _json_element("post", F.concat(F.lit("post://"), key), meta | {"is_comment": F.col("turn") > 0})
    profile = _json_element("profile", F.concat(F.lit("profile://"), key), {
        "href": F.concat(F.lit("http://"), key),
        "source": F.lit("vk"),
        "sm_profile_id": _text("conv_id"),
        "name": F.col("role"),
        "reach": (F.col("conv_id") + F.lit(0.25).cast("decimal(3,2)")).cast("decimal(20,2)"),
        "friend_count": F.col("turn"),
    })
    full = _json_element(None, F.concat(F.lit("detailed://"), key), meta | {
        "profile_name": F.col("role"),
        "reach": F.col("conv_id").cast("decimal(20,1)"),
        "sm_profile_id": F.col("conv_id"),
    })
    text = F.concat(F.lit("["), F.concat_ws(",", post, profile, full), F.lit("]"))
    parse_text = turns.where(~is_single).select(url.alias("url"), text.alias("text"), segment.alias("segment"))
    parse = fetch.where("1 = 0")
    return {"fetch": fetch, "parse": parse, "parse_data": parse_data, "parse_text": parse_text}


def dirty_parts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The same pages as crawls really are, by the conversation's number modulo 8: texts that are empty (0), JSON null (1) or
    broken (2), dates that cannot be read (3), elements without metadata (4), single pages of a type that holds nothing (5).
    Every record comes twice; the older fetch of a page is in the parse part."""
    parts = page_parts(spark, sf_dir)
    number = F.regexp_extract("url", "//([0-9]+)/", 1).cast("bigint") % 8
    text = (
        F.when(number == 0, "").when(number == 1, " null ").when(number == 2, "[{broken").when(number == 4, '[{"url":"x"}]')
        .when(number == 3, F.replace("text", F.lit("2016-05"), F.lit("May 16"))).otherwise(F.col("text"))
    )
    holds_nothing = (number == 5) & (F.element_at("content_meta", "multiple") == "false")
    content = F.when(holds_nothing, F.map_concat(
        F.map_filter("content_meta", lambda k, v: k != "type"), F.create_map(F.lit("type"), F.lit("group"))
    )).otherwise(F.col("content_meta"))
    twice = F.explode(F.array(F.lit(0), F.lit(1))).alias("_copy")
    dirty = {name: rows.select("*", twice).drop("_copy") for name, rows in parts.items()}
    dirty["parse_text"] = dirty["parse_text"].withColumn("text", text)
    dirty["parse_data"] = dirty["parse_data"].withColumn("content_meta", content)
    dirty["parse"] = parts["fetch"].withColumn("fetch_time", F.col("fetch_time") - 5)
    return dirty
