from __future__ import annotations

import datetime as dt
import json
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from build import detailed, posts, profiles, values
from postlake.functions import dates, hrefs, payload, text
from postlake.schemas import DETAILED, INDEX_KEYS, PLAIN_KEYS


def one(spark, column, **inputs):
    ddl = ", ".join(f"{name} string" for name in inputs)
    return spark.createDataFrame([tuple(inputs.values())], ddl).select(column).first()[0]


# An id of each form and the link it stands for.
LINKS = [
    ("fb://110522802337587/posts/110522802337587_904704769586049",
     "https://www.facebook.com/110522802337587/posts/904704769586049"),
    ("fb://106357469967/posts/106357469967_10154870368519968/comments/10154870368519968_10154875859849968",
     "https://www.facebook.com/106357469967/posts/10154870368519968?comment_id=10154875859849968"),
    ("vk://id135637359/posts/2918", "http://vk.com/wall135637359_2918"),
    ("vk://id131487475/posts/1675/comments/1678", "http://vk.com/wall131487475_1675?reply=1678"),
]
NO_LINKS = [
    "ok://1/posts/2", "vk://id1/photos/2", "vk://id1/posts/", "fb://1/posts/1", "fb://1/posts/1_2_3",
    "fb://1/posts/1/comments/2_3", "fb://1/posts/1_2/comments/", "vk://id1/posts/2/comments/", "vk", None,
]


@pytest.mark.parametrize("id_, link", LINKS)
def test_href(spark, id_, link):
    assert one(spark, hrefs.href("id"), id=id_) == link


@pytest.mark.parametrize("id_, link", [
    ("fb://1/posts/1_2_3/comments/4", "https://www.facebook.com/1/posts/2?comment_id=4"),
    ("fb://1/posts/1_2/", None),
    ("fb1_2", "https://www.facebook.com/fb1/posts/2"),
    ("fb://1/posts/1_2_", "https://www.facebook.com/1/posts/2"),
    ("vk://id1/posts/2/", "http://vk.com/wall1_2"),
    ("vk://id-5/posts/2", "http://vk.com/wall-5_2"),
])
def test_href_odd_ids(spark, id_, link):
    assert one(spark, hrefs.href("id"), id=id_) == link


@pytest.mark.parametrize("id_", NO_LINKS)
def test_href_unknown(spark, id_):
    assert one(spark, hrefs.href("id"), id=id_) is None
    with pytest.raises(Exception, match="no link for id"):
        one(spark, hrefs.href("id", strict=True), id=id_)


@pytest.mark.parametrize("date, local, utc, name", [
    ("2016-04-11T15:19:22.000+0300", dt.date(2016, 4, 11), "2016-04-11 12:19:22", "p-y2016-hy1-q2-m4"),
    ("2014-01-01T00:30:00+0300", dt.date(2014, 1, 1), "2013-12-31 21:30:00", "p-y2013-hy2-q4-m12"),
    ("2015-07-21T02:29:27.000+0300", dt.date(2015, 7, 21), "2015-07-20 23:29:27", "p-y2015-hy2-q3-m7"),
    ("2015-03-21T02:29:27.000+0300", dt.date(2015, 3, 21), "2015-03-20 23:29:27", "p-y2015-hy1-q1-m3"),
    ("1969-12-31T23:30:00-0300", dt.date(1969, 12, 31), "1970-01-01 02:30:00", "p-y1970-hy1-q1-m1"),
    ("1969-12-31T20:30:00+0000", dt.date(1969, 12, 31), "1969-12-31 20:30:00", "p-y1969-hy2-q4-m12"),
    ("2016-07-01T00:00:00.123+0300", None, None, None),
    ("2016-07-01T00:00:00Z", None, None, None),
    ("2016-07-01", None, None, None),
    ("bad", None, None, None),
    (None, None, None, None),
])
def test_dates(spark, date, local, utc, name):
    ts = dates.post_ts("d")
    row = spark.createDataFrame([(date,)], "d string").select(
        dates.local_date("d").alias("local"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("utc"),
        dates.index_name("p-", ts).alias("name"),
    ).first()
    assert (row.local, row.utc, row.name) == (local, utc, name)


def test_dates_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        date = "2014-01-01T00:30:00+0300"
        assert one(spark, dates.index_name("p-", dates.post_ts("d")), d=date) == "p-y2013-hy2-q4-m12"
        assert one(spark, dates.local_date("d"), d=date) == dt.date(2014, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unreadable_date_raises_if_strict(spark):
    for date in ("bad", None):
        with pytest.raises(Exception, match="unreadable post date"):
            one(spark, dates.post_ts("d", strict=True), d=date)


@pytest.mark.parametrize("number, expected", [
    ("2630.0", "2630"), ("12345678.0", "12345678"), ("102677859783352.0", "102677859783352"),
    ("1.05", "1.05"), ("null", None), ("7", "7"), ('"7.0"', "7"), ('"1_7"', "1_7"), ('"7.05"', "7.05"), ("true", "true"),
])
def test_number_text(spark, number, expected):
    assert one(spark, text.number_text("j", "$.n"), j=f'{{"n":{number}}}') == expected


def test_number_text_of_missing_field(spark):
    assert one(spark, text.number_text("j", "$.n"), j="{}") is None


def test_small_text_functions(spark):
    assert one(spark, text.row_key("u", "d"), u="vk://id1", d="5") == "vk://id1|5"
    assert one(spark, text.words("t"), t="To be, or NOT to-be; x_1 été") == [
        "to", "be", "or", "not", "to", "be", "x_1", "t"]
    assert one(spark, text.words("t"), t="--") == []
    assert [one(spark, text.not_empty("t"), t=t) for t in (None, "", " ", "a")] == [False, False, True, True]
    meta = spark.sql("SELECT map('a', 'b') AS m")
    assert meta.select(text.lookup("m", "a"), text.lookup("m", "z")).first()[:] == ("b", None)
    variant = spark.sql("SELECT parse_json('{\"t\":true,\"n\":null}') AS v")
    flags = variant.select(*[text.flag("v", f"$.{k}") for k in ("t", "n", "x")])
    assert flags.first()[:] == (True, False, False)
    assert one(spark, text.url_hash("u"), u="a") == one(spark, F.hash("u"), u="a")


LONG = "x" * 320


@pytest.mark.parametrize("json, expected", [
    ('[{"a":"%s","b":[1]}]' % LONG, '[{"a":"@","b":[1]}]'),
    ('[{"k":"it\'s \\" %s"},{"a" : "%s" ,"b":"%s"},7]' % ("y" * 200, LONG, LONG * 9), '[{"k":"it\'s \\" %s"},{"a" : "@" ,"b":"@"},7]' % ("y" * 200)),
    ("[{'k':'\"','a':\"%s\"}]" % LONG, "[{'k':'\"','a':\"@\"}]"),
    ('[{"a":"%s"}]' % ("\u00e9" * 192), '[{"a":"@"}]'), ('[{"a":"%s"}]' % ("\\ud83d\\ude00" * 192), '[{"a":"@"}]'),
    ('[{"a":"%s"}]' % ("\\n\\u0041" * 160), '[{"a":"@"}]'),
    *[(same, same) for same in (
        '[{"a":"%s"},{"b":"%s"}]' % (LONG[:256], "\u00e9" * 128), '[{"a":"%s"}]' % ("\\u0041" * 256), '["%s",["%s"]]' % (LONG, LONG),
        '[{"%s":1}]' % LONG, "[{'a':'%s'}]" % LONG, '[{"a":"%s\\x"}]' % LONG, '[{"a":"%s\n"}]' % LONG, '[{"a":"%s\\ud83d"}]' % LONG,
        '[{"a":"%s' % LONG, "", None,
    )],
])
def test_strings_past_a_limit_end_early_where_that_is_sure(spark, json, expected):
    found = one(spark, text.without_overlong("j", 256), j=json)
    ended = found and re.sub(rf'"[^"]*{text.OVERLONG}"', '"@"', found)
    assert ended == expected and len(found or "") <= len(json or "") + 2 * len(text.OVERLONG)


def sample(spark):
    return detailed(spark, {
        "url": "vk://id7/posts/9", "crawl_date": 1471434127594, "segment": "20160817143312",
        "href": "http://vk.com/wall7_9", "source": "vk", "profile_id": "vk://id7", "sm_post_id": "9",
        "body": "Первая строка\n\"вторая\" / третья \\", "engagement": "0", "profile_name": "Имя",
        "reach": "2630", "sm_profile_id": "7",
    })


def test_index_json_keys_order_and_nulls(spark):
    made = sample(spark).select(payload.index_json()).first()[0]
    pairs = json.loads(made, object_pairs_hook=list)
    assert [key for key, _ in pairs] == list(INDEX_KEYS)
    found = dict(pairs)
    assert found["profile_city"] is None and found["fetch_time"] == "1471434127594"
    assert found["is_comment"] is False and found["post_body"].startswith("Первая строка\n")


@pytest.mark.parametrize("kind, make", [("profile", profiles), ("post", posts), ("detailed", detailed)])
def test_plain_json_keys(spark, kind, make):
    made = make(spark, {"url": "u"}).select(payload.plain_json(kind)).first()[0]
    assert list(json.loads(made)) == list(PLAIN_KEYS[kind])


@pytest.mark.parametrize("encode", [payload.index_json, lambda: payload.plain_json("detailed")])
def test_decode_inverts_encode(spark, encode):
    rows = sample(spark)
    cells = rows.select(F.col("url").alias("id"), "crawl_date", encode().alias("json"))
    assert values(payload.decode_cells(cells, "detailed", strict=True)) == values(rows, *DETAILED.names)


def test_decode_keeps_unreadable_cells_apart(spark):
    cells = spark.createDataFrame([("a", 1, '{"body":"x"}'), ("b", 2, "{no")], "id string, crawl_date long, json string")
    decoded = payload.decode_cells(cells, "post")
    assert values(decoded, "url", "body", "is_comment", "_corrupt") == [
        ("a", "x", False, None), ("b", None, False, "{no")]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        payload.decode_cells(cells, "post", strict=True).collect()


texts = st.none() | st.text(st.characters(exclude_categories=["Cs"]), max_size=20)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(texts, texts, st.booleans()), min_size=1, max_size=30))
def test_decode_inverts_encode_for_any_text(spark, rows):
    made = detailed(spark, *[
        {"url": f"u{i}", "body": body, "profile_name": name, "is_comment": flag}
        for i, (body, name, flag) in enumerate(rows)
    ])
    for encode in (payload.index_json(), payload.plain_json("detailed")):
        cells = made.select(F.col("url").alias("id"), "crawl_date", encode.alias("json"))
        assert values(payload.decode_cells(cells, "detailed", strict=True)) == values(made, *DETAILED.names)


def test_message_round_trip(spark):
    rows = sample(spark)
    sent = rows.select(payload.message_json().alias("value"))
    read = sent.select(payload.decode_message("value", DETAILED).alias("r")).select("r.*")
    assert values(read, *DETAILED.names) == values(rows, *DETAILED.names)
    assert read.where("_corrupt IS NOT NULL").count() == 0
