"""SQL over the same tables, one statement per query, as DuckDB runs it."""

from __future__ import annotations


PROFILES = """
  SELECT CASE WHEN c_custkey % 2 = 0 THEN 'fb://' || c_custkey ELSE 'vk://id' || c_custkey END AS url,
    1470000000000 + c_custkey AS crawl_date,
    CASE WHEN c_custkey % 2 = 0 THEN 'fb://' || c_custkey ELSE 'vk://id' || c_custkey END AS id,
    c_mktsegment AS segment,
    CASE WHEN c_custkey % 2 = 0 THEN 'https://www.facebook.com/' || c_custkey
         ELSE 'http://vk.com/id' || c_custkey END AS href,
    CASE WHEN c_custkey % 2 = 0 THEN 'fb' ELSE 'vk' END AS source,
    CAST(c_custkey AS VARCHAR) AS sm_profile_id,
    c_name AS name,
    n_name AS city,
    CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS reach,
    CAST(c_nationkey AS VARCHAR) AS friend_count,
    CAST(NULL AS VARCHAR) AS follower_count,
    CASE c_nationkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS gender
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
"""

POSTS = """
  SELECT *, CASE WHEN url LIKE '%/comments/%' THEN true ELSE false END AS is_comment FROM (
  SELECT CASE
      WHEN o_custkey % 2 = 0 AND o_orderkey % 2 = 1 THEN 'fb://' || o_custkey || '/posts/' || o_custkey || '_'
        || o_orderkey || '/comments/' || o_orderkey || '_' || (o_orderkey + 1)
      WHEN o_custkey % 2 = 0 THEN 'fb://' || o_custkey || '/posts/' || o_custkey || '_' || o_orderkey
      WHEN o_orderkey % 2 = 1 THEN 'vk://id' || o_custkey || '/posts/' || o_orderkey || '/comments/'
        || (o_orderkey + 1)
      ELSE 'vk://id' || o_custkey || '/posts/' || o_orderkey END AS url,
    epoch_us(o_orderdate) // 1000 + 86400000 AS crawl_date,
    strftime(o_orderdate, '%Y%m') AS segment,
    'http://old.example/' || o_orderkey AS href,
    CASE WHEN o_custkey % 2 = 0 THEN 'fb' ELSE 'vk' END AS source,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL
         ELSE CASE WHEN o_custkey % 2 = 0 THEN 'fb://' ELSE 'vk://id' END || o_custkey
           || CASE WHEN o_orderkey % 5 = 0 THEN '0x' ELSE '' END END AS profile_id,
    CAST(o_orderkey AS VARCHAR) AS sm_post_id,
    CASE WHEN o_orderkey % 2 = 1 THEN
      CASE WHEN o_custkey % 2 = 0 THEN 'fb://' ELSE 'vk://id' END || o_custkey || '/posts/' || o_orderkey
      END AS parent_post_id,
    CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN ''
      ELSE o_orderpriority || ' ' || o_orderstatus END AS body,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000+0300' AS date,
    CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS engagement,
    o_orderdate, o_orderkey, o_custkey
  FROM orders)
"""

CRAWLS = """
  SELECT 'vk://id' || user_id AS url, epoch_us(ts) // 1000 AS crawl_date, event_type AS name,
    CAST(event_id AS VARCHAR) AS reach, event_id, event_type, user_id, ts
  FROM events
"""

PAGES = """
  SELECT *, length(text) AS size, conv_id || '/' || turn AS key, 's' || (conv_id % 10) AS seg,
    role = 'system' AS is_single,
    1470000000000 + conv_id * 1000 + turn AS fetch_time,
    DATE '2016-05-01' + CAST(conv_id % 20 AS INTEGER) AS day
  FROM conversations
"""

USABLE_PAGES = f"""
  SELECT * FROM ({PAGES}) WHERE size >= 70 AND size <= 1400 AND NOT size BETWEEN 250 AND 300
"""

MONTH_OF_UTC = """'y' || year(utc) || '-hy' || CASE WHEN month(utc) > 6 THEN 2 ELSE 1 END
    || '-q' || quarter(utc) || '-m' || month(utc)"""

HREF = r"""CASE
    WHEN url LIKE 'fb%' AND url LIKE '%/comments/%' THEN 'https://www.facebook.com/' || o_custkey || '/posts/'
      || o_orderkey || '?comment_id=' || (o_orderkey + 1)
    WHEN url LIKE 'fb%' THEN 'https://www.facebook.com/' || o_custkey || '/posts/' || o_orderkey
    WHEN url LIKE '%/comments/%' THEN 'http://vk.com/wall' || o_custkey || '_' || o_orderkey || '?reply='
      || (o_orderkey + 1)
    ELSE 'http://vk.com/wall' || o_custkey || '_' || o_orderkey END"""


POST_COLUMNS = """url, crawl_date, id, segment, href, source, profile_id, sm_post_id, parent_post_id, body, date,
    engagement, is_comment"""
DETAILED_COLUMNS = POST_COLUMNS + """, profile_city, profile_gender, profile_href, profile_name, reach,
    sm_profile_id"""
# Of POSTS, whose id is its url.
OF_POSTS = POST_COLUMNS.replace("id, segment", "url AS id, segment", 1)
POST_LIST = """p.url, p.crawl_date, p.url AS id, p.segment, p.href, p.source, p.profile_id, p.sm_post_id, p.parent_post_id,
    p.body, p.date, p.engagement, p.is_comment"""
AUTHOR_LIST = """a.city AS profile_city, a.gender AS profile_gender, a.href AS profile_href,
    a.name AS profile_name, a.reach, a.sm_profile_id"""


def enriched(which: str = "true") -> str:
    return f"""
  SELECT {POST_LIST}, {AUTHOR_LIST}, a.url IS NOT NULL AS author_matched
  FROM ({POSTS}) p LEFT JOIN (SELECT * FROM ({PROFILES}) WHERE {which}) a ON p.profile_id = a.url
"""


FIRST_HALF = "CAST(sm_profile_id AS BIGINT) % 3 = 0"


PROFILE_JSON = """CAST(json_object('smProfileId', sm_profile_id, 'name', name, 'city', city, 'reach', reach,
    'friendCount', friend_count, 'followerCount', follower_count, 'gender', gender, 'id', id, 'segment', segment,
    'crawlDate', CAST(crawl_date AS VARCHAR), 'href', href, 'source', source) AS VARCHAR)"""
POST_JSON = """CAST(json_object('profileId', profile_id, 'smPostId', sm_post_id, 'parentPostId', parent_post_id,
    'body', body, 'date', date, 'engagement', engagement, 'isComment', is_comment, 'id', id, 'segment', segment,
    'crawlDate', CAST(crawl_date AS VARCHAR), 'href', href, 'source', source) AS VARCHAR)"""
INDEX_JSON = """CAST(json_object('profile_city', profile_city, 'profile_gender', profile_gender,
    'profile_href', profile_href, 'profile_name', profile_name, 'reach', reach, 'sm_profile_id', sm_profile_id,
    'profile_id', profile_id, 'sm_post_id', sm_post_id, 'parent_post_id', parent_post_id, 'post_body', body,
    'post_date', date, 'engagement', engagement, 'is_comment', is_comment, 'id', id, 'segment', segment,
    'fetch_time', CAST(crawl_date AS VARCHAR), 'post_href', href, 'source', source) AS VARCHAR)"""


def _index(posts: str) -> str:
    """Index rows of detailed posts with text and a local year from 1998 on."""
    return f"""
  SELECT 'posts-monthly-' || {MONTH_OF_UTC} AS index_name, url AS _id, {INDEX_JSON} AS source
  FROM (SELECT *, strptime(replace(date, '.000+0300', ''), '%Y-%m-%dT%H:%M:%S') - INTERVAL 3 HOUR AS utc
        FROM ({posts}))
  WHERE body IS NOT NULL AND body <> '' AND CAST(left(date, 4) AS INTEGER) >= 1998
"""


POST_FIELDS = """
    seg AS segment, 'http://' || key AS href, 'vk' AS source, 'vk://id' || conv_id AS profile_id,
    CAST(conv_id AS VARCHAR) AS sm_post_id, CAST(NULL AS VARCHAR) AS parent_post_id, text AS body,
    strftime(day, '%Y-%m-%d') || 'T00:30:00.000+0300' AS date, CAST(turn * 1000000 AS VARCHAR) AS engagement
"""

EXTRACTED_POSTS = f"""
  SELECT 'post://' || key AS url, fetch_time AS crawl_date, 'post://' || key AS id, {POST_FIELDS},
    turn > 0 AS is_comment
  FROM ({USABLE_PAGES}) WHERE NOT is_single AND day > DATE '2016-08-10' - 90
"""
EXTRACTED_DETAILED = f"""
  SELECT 'detailed://' || key AS url, fetch_time AS crawl_date, 'detailed://' || key AS id, {POST_FIELDS},
    false AS is_comment, CAST(NULL AS VARCHAR) AS profile_city, CAST(NULL AS VARCHAR) AS profile_gender,
    CAST(NULL AS VARCHAR) AS profile_href, role AS profile_name,
    CAST(conv_id AS VARCHAR) AS reach, CAST(conv_id AS VARCHAR) AS sm_profile_id
  FROM ({USABLE_PAGES}) WHERE NOT is_single AND day > DATE '2016-05-20' - 7
"""
EXTRACTED_PROFILES = f"""
  SELECT CASE WHEN is_single THEN 'page://' ELSE 'profile://' END || key AS url, fetch_time AS crawl_date,
    CASE WHEN is_single THEN 'page://' ELSE 'profile://' END || key AS id, seg AS segment,
    'http://' || key AS href, 'vk' AS source, CAST(conv_id AS VARCHAR) AS sm_profile_id, role AS name,
    CAST(NULL AS VARCHAR) AS city,
    CASE WHEN is_single THEN '7.0' ELSE conv_id || '.25' END AS reach,
    CASE WHEN NOT is_single THEN CAST(turn AS VARCHAR) END AS friend_count,
    CAST(NULL AS VARCHAR) AS follower_count, CAST(NULL AS VARCHAR) AS gender
  FROM ({USABLE_PAGES})
"""

_MONTHS = "SELECT *, strftime(o_orderdate, '%Y-%m') AS segment FROM orders"

# Months that have each part of the landing tables.
_COMPLETE = f"""SELECT segment FROM ({_MONTHS}) GROUP BY segment
        HAVING bool_or(o_orderkey % 3 = 0) AND bool_or(o_orderkey % 101 = 0) AND bool_or(o_orderkey % 5 = 0)"""

_USER_LATEST = """SELECT url, crawl_date, name, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY ts DESC, event_id DESC) AS r
    FROM (%s) WHERE %s) WHERE r = 1"""
_NEW = f"""SELECT url, 1470000000000 + CAST(floor(CAST(reach AS BIGINT) / 400.0) AS BIGINT) AS crawl_date, name
    FROM ({PROFILES})"""
_SAVED = f"""SELECT url, 1470000000000 + CAST(friend_count AS BIGINT) AS crawl_date, 'saved ' || name AS name
    FROM ({PROFILES}) WHERE segment <> 'BUILDING'"""


def _matched(sql: str, flag: bool) -> str:
    names = DETAILED_COLUMNS if flag else POST_COLUMNS
    return f"SELECT {names} FROM ({sql}) WHERE {'' if flag else 'NOT '}author_matched"


ORACLE: dict[str, str] = {
    "latest_profile": _USER_LATEST % (CRAWLS, "true"),
    "top_crawls": f"""SELECT url, crawl_date, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY url ORDER BY ts DESC, event_id DESC) AS r
        FROM ({CRAWLS})) WHERE r <= 3""",
    "distinct_crawls": f"""SELECT url, CAST(ts AS DATE) AS day, min(event_id) AS event_id
        FROM ({CRAWLS}) GROUP BY 1, 2""",
    "conditional_upsert": f"""SELECT n.* FROM ({_NEW}) n LEFT JOIN ({_SAVED}) s USING (url)
        WHERE s.url IS NULL OR s.crawl_date < n.crawl_date""",
    "upsert_profile_view": f"""SELECT url, crawl_date, name FROM (
        SELECT *, row_number() OVER (PARTITION BY url ORDER BY crawl_date DESC, is_new) AS r
        FROM (SELECT *, 0 AS is_new FROM ({_SAVED}) UNION ALL SELECT *, 1 FROM ({_NEW}))) WHERE r = 1""",
    "post_view": f"""SELECT url, max(crawl_date) AS crawl_date, count(DISTINCT crawl_date) AS crawls
        FROM ({CRAWLS}) GROUP BY url""",
    "post_enrich": enriched(),
    "posts_with_author": _matched(enriched(), True),
    "posts_without_author": _matched(enriched(), False),
    "posts_lacking_author": _matched(enriched(), False),
    "retry_cycle": f"""
        SELECT p.*, {AUTHOR_LIST}, a.url IS NOT NULL AS author_matched
        FROM ({_matched(enriched(FIRST_HALF), False)}) p
        LEFT JOIN (SELECT * FROM ({PROFILES}) WHERE NOT {FIRST_HALF}) a ON p.profile_id = a.url""",
    "clean_profiles": f"SELECT * FROM ({PROFILES}) WHERE segment NOT LIKE 'B%'",
    "clean_profile_urls": f"SELECT * FROM ({PROFILES}) WHERE NOT starts_with(url, 'fb')",
    "href_repair": f"SELECT url, {HREF} AS href FROM ({POSTS})",
    "index_route": f"""SELECT 'posts-monthly-' || {MONTH_OF_UTC} AS index_name, count(*) AS n
        FROM (SELECT o_orderdate AS utc FROM orders) GROUP BY 1""",
    "index_route_offset": f"""SELECT sm_post_id, year(o_orderdate) AS local_year,
          CAST(utc AS DATE) AS utc_date, 'posts-monthly-' || {MONTH_OF_UTC} AS index_name
        FROM (SELECT *, o_orderdate - INTERVAL 3 HOUR AS utc FROM ({POSTS}))""",
    "min_year": f"SELECT url, date FROM ({POSTS}) WHERE year(o_orderdate) >= 1998",
    "recent_posts_90": f"SELECT url, date FROM ({POSTS}) WHERE o_orderdate > DATE '2001-08-01' - 90",
    "recent_posts_7": f"SELECT url, date FROM ({POSTS}) WHERE o_orderdate > DATE '2001-08-01' - 7",
    "nonempty_body": """SELECT doc_id, body FROM (
        SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' ELSE text END AS body
        FROM documents) WHERE body IS NOT NULL AND body <> ''""",
    "segment_scan": f"""SELECT part, count(*) AS records, count(DISTINCT url) AS pages FROM (
        SELECT 'fetch' AS part, key AS url FROM ({PAGES}) UNION ALL SELECT 'parse_data', key FROM ({PAGES})
        UNION ALL SELECT 'parse_text', key FROM ({PAGES}) WHERE NOT is_single) GROUP BY part""",
    "status_filter": f"""SELECT part, 'page://' || key AS url FROM (
        SELECT 'fetch' AS part, key FROM ({PAGES}) WHERE size >= 70
        UNION ALL SELECT 'parse_data', key FROM ({PAGES}) WHERE size <= 1400
        UNION ALL SELECT 'parse_text', key FROM ({PAGES}) WHERE NOT is_single)""",
    "segment_counts": f"""SELECT seg AS segment, count(*) AS records FROM (
        SELECT seg FROM ({PAGES}) WHERE size >= 70
        UNION ALL SELECT seg FROM ({PAGES}) WHERE size <= 1400
        UNION ALL SELECT seg FROM ({PAGES}) WHERE NOT is_single) GROUP BY seg""",
    "assemble_documents": """
        SELECT 'doc://' || d.doc_id AS url, 1470000000000 + d.doc_id AS crawl_date, d.lang AS segment,
          p.html AS text
        FROM documents d JOIN labels l USING (doc_id) LEFT JOIN pages p ON p.page_id = d.doc_id
        WHERE d.n_chars >= 500 AND l.quality = 1 AND l.toxic = 0""",
    "assemble_pages": f"""
        SELECT seg AS from_segment, 'page://' || key AS url, fetch_time AS crawl_date,
          CASE WHEN is_single THEN 'profile' ELSE 'detailed_post' END AS page_type,
          CASE WHEN is_single THEN 'single' ELSE 'multi' END AS route, NOT is_single AS has_text
        FROM ({USABLE_PAGES})""",
    "unnest_results": f"""
        SELECT 'page://' || key AS page_url, url_kind || key AS url, kind FROM ({USABLE_PAGES}) JOIN (
          VALUES (false, 'post://', 'post'), (false, 'profile://', 'profile'),
            (false, 'detailed://', 'detailed'), (true, 'page://', 'profile')) k(single, url_kind, kind)
          ON single = is_single""",
    "extract_posts": EXTRACTED_POSTS,
    "extract_profiles": EXTRACTED_PROFILES,
    "extract_detailed": EXTRACTED_DETAILED,
    "extract_dirty": f"""
        SELECT kind, reason, count(*) AS n, CAST(sum(fetch_time) AS BIGINT) AS crawl_sum FROM (
          SELECT fetch_time, 'profile' AS kind, NULL AS reason FROM ({USABLE_PAGES})
          WHERE CASE WHEN is_single THEN conv_id % 8 <> 5 ELSE conv_id % 8 IN (3, 5, 6, 7) END
          UNION ALL SELECT fetch_time, 'post', NULL FROM ({USABLE_PAGES})
          WHERE NOT is_single AND conv_id % 8 IN (5, 6, 7) AND day > DATE '2016-05-20' - 90
          UNION ALL SELECT fetch_time, 'detailed', NULL FROM ({USABLE_PAGES})
          WHERE NOT is_single AND conv_id % 8 IN (5, 6, 7) AND day > DATE '2016-05-20' - 7
          UNION ALL SELECT fetch_time, 'quarantine', 'unreadable post date'
          FROM ({USABLE_PAGES}), (VALUES ('post'), ('detailed')) k(kind) WHERE NOT is_single AND conv_id % 8 = 3
          UNION ALL SELECT fetch_time, 'quarantine', 'page text is no JSON array'
          FROM ({USABLE_PAGES}) WHERE NOT is_single AND conv_id % 8 = 2
          UNION ALL SELECT fetch_time, 'quarantine', 'element lacks metadata'
          FROM ({USABLE_PAGES}) WHERE NOT is_single AND conv_id % 8 = 4)
        GROUP BY kind, reason""",
    "demux_counts": """
        SELECT 'profile' AS kind, count(*) AS n FROM customer UNION ALL
        SELECT 'post', count(*) FROM orders UNION ALL SELECT 'detailed', count(*) FROM events""",
    "extract_large": f"""SELECT url, 'post' AS kind, NULL AS reason, crawl_date, body FROM ({EXTRACTED_POSTS})
        UNION ALL SELECT 'page://' || key, 'quarantine', 'element is too large to read', fetch_time, NULL
        FROM ({USABLE_PAGES}) WHERE NOT is_single AND conv_id % 2000 = 0 AND turn = 1""",
    "segment_range": f"""SELECT segment, count(*) AS n FROM ({_MONTHS})
        WHERE segment >= '1996-02-15' AND segment <= coalesce(
          (SELECT min(segment) FROM ({_MONTHS}) WHERE segment >= '1997-06-15'),
          (SELECT max(segment) FROM ({_MONTHS}))) AND segment IN ({_COMPLETE})
        GROUP BY segment""",
    "single_segment": f"""SELECT segment, CAST(o_orderkey AS VARCHAR) AS url FROM ({_MONTHS})
        WHERE segment = '1998-04' AND segment IN ({_COMPLETE})""",
    "complete_segments": f"SELECT segment, count(*) AS n FROM ({_MONTHS}) WHERE segment IN ({_COMPLETE}) GROUP BY segment",
    "missing_path": f"SELECT url, crawl_date FROM ({PROFILES}) UNION ALL SELECT url, crawl_date FROM ({POSTS})",
    "publish_again": f"SELECT url FROM ({EXTRACTED_POSTS}) WHERE segment IN ('s0', 's1', 's2', 's5', 's9')",
    "stream_replay": f"SELECT url, crawl_date FROM ({POSTS})",
    "stream_counts": f"""SELECT 'ingest ' || source AS name, count(*) AS n FROM ({POSTS}) GROUP BY source
        UNION ALL SELECT 'ingest profiles', 2 * count(*) FROM customer""",
    "bulk_index": _index(_matched(enriched(), True)),
    "bounded_export": f"SELECT url, place FROM ({POSTS}), (VALUES ('read'), ('kept')) t(place)",
    "index_json": f"SELECT url, {INDEX_JSON} AS source FROM ({enriched()})",
    "profile_json": f"SELECT url, {PROFILE_JSON} AS json FROM ({PROFILES})",
    "post_json": f"""SELECT url, {POST_JSON} AS json
        FROM (SELECT {OF_POSTS} FROM ({POSTS}))""",
    "profile_cells": PROFILES,
    "post_cells": f"SELECT {OF_POSTS} FROM ({POSTS})",
    "spread_rows": "SELECT event_id, event_type FROM events",
    "local_sort": f"SELECT url, crawl_date, name FROM ({CRAWLS})",
    "segment_total": f"""SELECT count(*) AS records FROM (
        SELECT seg FROM ({PAGES}) WHERE size >= 70 UNION ALL SELECT seg FROM ({PAGES}) WHERE size <= 1400
        UNION ALL SELECT seg FROM ({PAGES}) WHERE NOT is_single)""",
    "extract_segments": f"SELECT * FROM ({EXTRACTED_POSTS}) WHERE segment BETWEEN 's2' AND 's6' OR segment = 's9'",
    "build_profile_view": f"""SELECT url, coalesce(
          CASE WHEN s.crawl_date >= n.crawl_date THEN s.crawl_date END, n.crawl_date) AS crawl_date,
          CASE WHEN s.crawl_date >= n.crawl_date THEN s.name ELSE n.name END AS name
        FROM ({_NEW}) n LEFT JOIN ({_SAVED}) s USING (url)""",
    "build_post_view": f"""SELECT * REPLACE (
          CASE WHEN is_comment THEN crawl_date + 1 ELSE crawl_date END AS crawl_date,
          CASE WHEN is_comment THEN 'again' ELSE segment END AS segment) FROM (SELECT {OF_POSTS} FROM ({POSTS}))""",
    "build_post_join": f"""SELECT url, profile_name,
          CASE WHEN author_matched THEN 'post_to_es' ELSE 'post_without_profile' END AS queue
        FROM ({enriched()})""",
    "repair_hrefs": f"""SELECT 'post' AS table_name, url, CASE WHEN o_orderkey % 13 = 0 THEN href ELSE fixed END AS href, body
        FROM (SELECT *, {HREF} AS fixed FROM ({POSTS}))
        UNION ALL SELECT 'unrepaired', url, href, body FROM ({POSTS}) WHERE o_orderkey % 13 = 0""",
    "cells_decode": _matched(enriched(), True),
    "json_decode": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "number_text": """SELECT o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS whole,
          CAST(CAST(floor(o_totalprice) AS BIGINT) * 1000003 AS VARCHAR) AS large,
          CAST(o_orderkey % 1000 AS VARCHAR) || '.05' AS fraction, CAST(NULL AS VARCHAR) AS missing
        FROM orders""",
    "row_keys": f"SELECT url || '|' || crawl_date AS row_key FROM ({POSTS})",
    "word_count": """SELECT word, count(*) AS n FROM (
        SELECT unnest(regexp_split_to_array(lower(text), '[^a-zA-Z_0-9]+')) AS word FROM documents)
        WHERE word <> '' GROUP BY word""",
    "index_queue": f"""
        SELECT {DETAILED_COLUMNS} FROM (
          SELECT *, row_number() OVER (PARTITION BY url ORDER BY crawl_date DESC, is_direct DESC) AS r FROM (
            SELECT *, 0 AS is_direct FROM ({_matched(enriched(), True)}) UNION ALL
            SELECT * REPLACE ('streamed' AS segment), 1 FROM ({_matched(enriched(FIRST_HALF), True)}) UNION ALL
            SELECT * REPLACE (crawl_date + 1 AS crawl_date, 'direct' AS segment), 1
            FROM ({_matched(enriched(), True)}) WHERE is_comment)) WHERE r = 1""",
    "index_rows": _index(_matched(enriched(), True)),
    "export_for_index": f"""SELECT url, body, CAST(left(date, 10) AS DATE) AS post_local_date
        FROM ({_matched(enriched(), True)}) WHERE body IS NOT NULL AND body <> ''""",
    "publish_topics": f"SELECT 'profile' AS kind, url, crawl_date FROM ({EXTRACTED_PROFILES}) UNION ALL "
        f"SELECT 'post', url, crawl_date FROM ({EXTRACTED_POSTS}) UNION ALL "
        f"SELECT 'detailed', url, crawl_date FROM ({EXTRACTED_DETAILED})",
    "stream_ingest": f"""SELECT DISTINCT 'profile' AS queue, url, crawl_date FROM ({CRAWLS})
        UNION ALL SELECT 'post', url, crawl_date FROM ({POSTS})
        UNION ALL SELECT 'detailed', url, crawl_date FROM ({_matched(enriched(), True)})
        UNION ALL SELECT 'bad', '{{broken ' || reach, 0 FROM ({CRAWLS}) WHERE name = 'purchase'""",
    "stream_index": _index(_matched(enriched(), True)),
    "rotate_queues": f"""SELECT 'post_to_process' AS queue, count(*) AS n
        FROM ({_matched(enriched(), False)}) UNION ALL
        SELECT name, 0 FROM (VALUES ('profile_to_process'), ('post_to_es'), ('post'),
          ('post_without_profile')) t(name)""",
    "cycle_output": _index(_matched(enriched(), True)),
}
