"""Documents out of assembled pages.

A single-document page is a profile described by its string metadata. A
multi-document page carries a JSON array, one element per document, read through
variant so that numbers keep their digits. A text larger than a variant takes is
split into its elements first, so only an element that is itself too large is
set aside.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.dates import days_before, local_date
from postlake.functions.text import OVERLONG, TRAILING_ZERO, not_empty
from postlake.operators.filters import DETAILED_DAYS, POST_DAYS
from postlake.schemas import (
    DETAILED,
    EXTRACTED,
    META_TYPE,
    POST,
    PROFILE,
    TYPE_DETAILED,
    TYPE_POST,
    TYPE_PROFILE,
)

NOT_JSON = "page text is no JSON array"
TOO_LARGE = "element is too large to read"
BAD_ELEMENT = "element lacks metadata"
BAD_DATE = "unreadable post date"
# Fixed value: bytes up to which Spark's variant is sure to take a text.
SURE_BYTES = 16 << 20
NO_LIMIT = {"maxStringLen": str((1 << 31) - 1)}
JSON_NULL = r"^\s*null\s*$"

# Number fields, by the kinds of element in which they are one.
NUMBERS = {
    "sm_post_id": "'post', 'detailed'",
    "engagement": "'post', 'detailed'",
    "reach": "'profile', 'detailed'",
    "friend_count": "'profile'",
    "follower_count": "'profile'",
    "sm_profile_id": "'detailed'",
}
_SCHEMAS = {"profile": PROFILE, "post": POST, "detailed": DETAILED}
_OWN = ("url", "crawl_date", "id", "segment", "kind", "reason")
_META = ", ".join(
    f"{f.name}: {f.dataType.simpleString()}" for f in EXTRACTED.fields if f.name not in _OWN
)
# A document as it stands in a page. One cast reads all of its fields.
ELEMENT = f"struct<url: string, contentMeta: struct<{META_TYPE}: string>, parseMeta: struct<{_META}>>"


def _readable(element: Column) -> Column:
    return F.struct(element.alias("element"), F.lit(None).cast("string").alias("unreadable"))


def unnest(pages: DataFrame, large_bytes: int = SURE_BYTES) -> DataFrame:
    """One row per document, with `kind`, or with a `reason` it cannot be read. Texts
    of more than `large_bytes` are split before they are read.

    Pages and elements that hold no document give no row. A single-document page
    is brought into the form of an element, so both sorts of page go through the
    same pass and the join below runs once.
    """
    multi = F.col("route") == "multi"
    # A page text of JSON null is an empty result, not a malformed one.
    has_results = not_empty("text") & ~F.col("text").rlike(JSON_NULL)
    candidates = pages.where(F.when(multi, has_results).otherwise(F.col("page_type") == TYPE_PROFILE))
    kept = ("from_segment", "crawl_date", "segment", "page_type", "route")
    # The elements of a large page are variants of their own; if one of them is too large, they are split off as text, which has
    # no limit, and read as arrays of one. So they are if one of them has a string that ends early, and that one is not read. All of
    # it is one expression, so no row but the page's own carries its text.
    cut = F.contains("text", F.lit(OVERLONG))
    large = (F.octet_length("text") > large_bytes) | cut
    whole = F.from_json(F.when(large, F.col("text")), "array<variant>", NO_LIMIT)
    whole = F.when(~cut | ~F.exists(whole, lambda v: F.to_json(v).contains(OVERLONG)), whole)
    split = F.coalesce(F.from_json("text", "array<string>", NO_LIMIT), F.array(F.lit("")))

    def as_given(json: Column, unreadable: Column) -> Column:
        return F.struct(json.alias("json"), unreadable.alias("unreadable"))

    def one(piece: Column) -> Column:
        given = F.coalesce(piece, F.lit("null"))
        unreadable = F.when(given.startswith("{"), TOO_LARGE).when(given != "", BAD_ELEMENT).otherwise(NOT_JSON)
        return as_given(F.when((given != "") & ~given.contains(OVERLONG), F.concat(F.lit("["), given, F.lit("]"))), unreadable)

    def read(piece: Column) -> Column:
        found = F.try_variant_get(F.try_parse_json(piece.json), "$", f"array<{ELEMENT}>")
        return F.coalesce(F.transform(found, _readable), F.array(F.struct(F.lit(None).cast(ELEMENT).alias("element"), piece.unreadable)))

    pieces = F.when(large, F.transform(split, one)).otherwise(F.array(as_given(F.col("text"), F.lit(NOT_JSON))))
    parsed = F.coalesce(
        F.transform(whole, lambda v: _readable(F.try_variant_get(v, "$", ELEMENT))), F.flatten(F.transform(pieces, read))
    )
    page = F.struct(
        "url", F.struct(F.col("page_type").alias(META_TYPE)).alias("contentMeta"),
        F.col("parse_meta").alias("parseMeta"),
    )
    whole_page = F.array(_readable(F.try_variant_get(F.to_variant_object(page), "$", ELEMENT)))
    found = candidates.select(*kept, F.col("url").alias("page_url"), F.explode(F.when(multi, parsed).otherwise(whole_page)).alias("found"))
    rows = found.select(*kept, "page_url", "found.element", "found.unreadable")
    lacks_meta = F.col("element.contentMeta").isNull() | F.col("element.parseMeta").isNull()
    reason = F.when(F.col("unreadable").isNotNull(), F.col("unreadable")).when(multi & lacks_meta, BAD_ELEMENT)
    subtype = F.coalesce(F.col(f"element.contentMeta.{META_TYPE}"), F.col("page_type"))
    kind = (
        F.when(reason.isNotNull(), "quarantine")
        .when(subtype == TYPE_POST, "post")
        .when(subtype == TYPE_PROFILE, "profile")
        .when(subtype == TYPE_DETAILED, "detailed")
    )
    url = F.col("element.url")
    return rows.select(
        *kept, "page_url", "element",
        F.when(reason.isNotNull(), F.coalesce(url, "page_url")).otherwise(url).alias("url"),
        kind.alias("kind"),
        reason.alias("reason"),
    ).where(F.col("kind").isNotNull())


def _value(name: str) -> str:
    """A metadata field, for the kinds that have it. Page metadata is taken as it is."""
    kinds = ", ".join(f"'{kind}'" for kind, schema in _SCHEMAS.items() if name in schema.names)
    value = f"element.parseMeta.{name}"
    if name == "is_comment":
        value = f"coalesce({value}, false)"
    elif name in NUMBERS:
        # Large numbers of elements split off as text come in powers of ten.
        plain = f"regexp_replace(try_cast({value} AS DECIMAL(38, 9)), r'[.]?0+$', '')"
        plain = f"CASE WHEN {value} LIKE '%E%' THEN coalesce({plain}, {value}) ELSE {value} END"
        as_number = f"regexp_replace({plain}, r'{TRAILING_ZERO}', '')"
        value = f"CASE WHEN route = 'multi' AND kind IN ({NUMBERS[name]}) THEN {as_number} ELSE {value} END"
    return f"CASE WHEN kind IN ({kinds}) THEN {value} END AS {name}"


def project(documents: DataFrame) -> DataFrame:
    """Every record column of each document; those of other kinds are null."""
    known = {"id": "url AS id"} | {n: n for n in _OWN if n != "id"}
    return documents.selectExpr("from_segment", *[known.get(n) or _value(n) for n in EXTRACTED.names])


def keep_recent(
    records: DataFrame,
    as_of: Column | dt.date | str | None = None,
    post_days: int = POST_DAYS,
    detailed_days: int = DETAILED_DAYS,
) -> DataFrame:
    """Drop posts past their age limit; posts without a readable date are kept
    as quarantined rows."""
    day = local_date("date")
    limit = F.when(F.col("kind") == "post", days_before(as_of, post_days)).when(
        F.col("kind") == "detailed", days_before(as_of, detailed_days)
    )
    # Undated kinds have no limit; an unreadable date passes, to be marked below.
    kept = records.where(limit.isNull() | (F.coalesce(day, F.lit(dt.date.max)) > limit))
    unreadable = limit.isNotNull() & day.isNull()
    return kept.withColumns(
        {
            "reason": F.when(unreadable, F.lit(BAD_DATE)).otherwise(F.col("reason")),
            "kind": F.when(unreadable, F.lit("quarantine")).otherwise(F.col("kind")),
        }
    )


def raise_on_quarantine(records: DataFrame) -> DataFrame:
    """Fail on the first row that would be quarantined."""
    message = F.concat(F.col("reason"), F.lit(": "), F.coalesce("url", F.lit("null")))
    failing = F.when(F.col("kind") == "quarantine", F.raise_error(message).cast("string"))
    return records.withColumn("reason", failing)


def demux(records: DataFrame, kind: str) -> DataFrame:
    """The records of one kind, with the columns of that kind."""
    return records.where(F.col("kind") == kind).select(*_SCHEMAS[kind].names)
