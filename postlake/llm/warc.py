"""WARC derivatives: from response records to metadata and plain-text conversion records that refer to them.

Each response gives two records. Both name the response in WARC-Refers-To, keep its target and date, and carry digests of
their own block and of the response's payload. The metadata block (application/warc-fields) keeps the response's content
type, length and payload digest, and lists its title and outlinks; it also names the conversion, and the conversion names it in
WARC-Concurrent-To. The conversion block is the plain text of the page.

Everything is column expressions over one scan: no shuffle, and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements whose content is no text, and elements that end a line of text.
SILENT = ("script", "style", "noscript", "template")
# Names that begin alike share a branch, and each pattern takes what it replaces only where that changes the text.
BLOCKS = (
    "a(?:ddress|rticle|side)|b(?:lockquote|ody|r)|d(?:d|iv|[lt])|f(?:igure|o(?:oter|rm))|h(?:[1-6r]|ead(?:er)?|tml)|li|main|nav|ol|"
    "p(?:re)?|section|t(?:able|[dhr]|itle)|ul"
)
# Character references, in the order they are replaced; the ampersand comes last.
ENTITIES = (
    ("&nbsp;", " "), ("&copy;", "©"), ("&reg;", "®"), ("&middot;", "·"), ("&hellip;", "…"), ("&ndash;", "–"), ("&mdash;", "—"),
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#34;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&amp;", "&"),
)
COMMENT = r"(?s)<!--.*?-->"
TEXT_STEPS = (
    (r"[\t\r\n\f][\t\r\n\f ]*+| [\t\r\n\f ]++", " "),
    (rf"(?i)</?+(?:{BLOCKS})\b[^>]*+>", "\n"),
    (r"<[A-Za-z/!?][^>]*+>", ""),
)
LAYOUT_STEPS = ((r"[\t\r\f][\t\r\f ]*+| [\t\r\f ]++", " "), (r" \n[\n ]*+|\n[\n ]++", "\n"), (r"^[\n ]++|[\n ]++$", ""))
OUTLINK = r"(?i)<a\s[^>]*?href\s*=\s*[\x22\x27]([^\x22\x27]*)[\x22\x27]"
TITLE = r"(?is)<title[^>]*>(.*?)</title"
SITE = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
RECORDS = "record_id", "record_type", "refers_to", "target_uri", "date", "content_type", "block", "block_digest", "payload_digest"


def _steps(value: Column, steps: tuple) -> Column:
    for pattern, by in steps:
        value = F.regexp_replace(value, pattern, by)
    return value


def with_text(rows: DataFrame, html: str) -> DataFrame:
    """Adds `_shown`, a page without its comments, and `_text`: no scripts or styles either, a line for each block element, references
    replaced, blanks folded. A script or style that is never closed loses its tag alone, an open comment all up to the next
    tag's end. Pages are searched by pattern only for what a plain look finds in them; each step is a column of its own, so none is
    worked out twice."""

    def replaced(name: str, change: Column, held: Column, mark: str) -> Column:
        return F.when(F.contains(held, F.lit(mark)), change).otherwise(F.col(name))

    rows = rows.withColumn("_shown", F.col(html))
    rows = rows.withColumn("_shown", replaced("_shown", F.regexp_replace("_shown", COMMENT, " "), F.col("_shown"), "<!--"))
    rows = rows.withColumns({"_low": F.lower("_shown"), "_text": F.col("_shown")})
    for element in SILENT:
        removed = F.regexp_replace("_text", rf"(?is)<{element}\b.*?</{element}\s*>", " ")
        rows = rows.withColumn("_text", replaced("_text", removed, F.col("_low"), f"<{element}"))
    rows = rows.withColumn("_text", _steps(F.col("_text"), TEXT_STEPS))
    known = F.col("_text")
    for name, char in ENTITIES:
        known = F.replace(known, F.lit(name), F.lit(char))
    rows = rows.withColumn("_text", replaced("_text", known, F.col("_text"), "&"))
    return rows.withColumn("_text", _steps(F.col("_text"), LAYOUT_STEPS))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def record_id(kind: str, *parts: Column) -> Column:
    """A name that is the same in every run, made from what the record stands for."""
    key = F.md5(F.concat_ws("\n", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    bits = [F.substring(key, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *bits), F.lit(">"))


def responses(pages: DataFrame, date: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Response records of fetched pages; null urls and pages count as empty."""
    target, payload = F.coalesce(F.col(url), F.lit("")), F.coalesce(F.col(html), F.lit(""))
    return pages.select(
        F.col(key).alias("source_key"),
        record_id("response", F.col(key), target, payload).alias("record_id"),
        target.alias("target_uri"), F.lit(date).alias("date"), F.lit("text/html").alias("content_type"),
        payload.alias("payload"), digest(payload).alias("payload_digest"),
    )


def derivatives(found: DataFrame) -> DataFrame:
    """Two rows for each response: source_key and the columns of a record.

    An empty page gives an empty conversion and metadata without title and links. Repeated responses give repeated records.
    Links that begin with "/" are resolved against the site of the target, others stay as written, in page order with repeats;
    line ends within them and within titles become blanks.
    """
    shown = F.col("_shown")
    site = F.regexp_extract("target_uri", SITE, 1)
    one_line = lambda c: F.trim(F.regexp_replace(c, r"[\r\n]+", " "))
    links = F.transform(
        F.regexp_extract_all(shown, F.lit(OUTLINK), F.lit(1)),
        lambda x: F.concat(F.lit("outlink: "), one_line(F.when(x.startswith("/") & ~x.startswith("//"), F.concat(site, x)).otherwise(x))),
    )
    made = with_text(found, "payload").select(
        "source_key", "target_uri", "date", "payload_digest", F.col("content_type").alias("source_type"),
        F.col("record_id").alias("refers_to"),
        F.octet_length("payload").alias("source_length"),
        one_line(F.regexp_extract(shown, TITLE, 1)).alias("title"),
        links.alias("links"),
        F.col("_text").alias("text"),
        record_id("metadata", F.col("record_id")).alias("metadata_id"),
        record_id("conversion", F.col("record_id")).alias("conversion_id"),
    )
    fields = F.concat_ws(
        "\r\n",
        F.concat(F.lit("source-content-type: "), "source_type"),
        F.concat(F.lit("source-content-length: "), F.col("source_length").cast("string")),
        F.concat(F.lit("source-payload-digest: "), "payload_digest"),
        F.concat(F.lit("conversion-record-id: "), "conversion_id"),
        F.when(F.col("title") != "", F.concat(F.lit("title: "), "title")),
        F.col("links"),
    )
    pair = F.explode(F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.col("metadata_id").alias("record_id"),
                 F.lit("application/warc-fields").alias("content_type"), F.concat(fields, F.lit("\r\n")).alias("block"),
                 F.col("conversion_id").alias("linked_id")),
        F.struct(F.lit("conversion").alias("record_type"), F.col("conversion_id").alias("record_id"),
                 F.lit("text/plain").alias("content_type"), F.col("text").alias("block"), F.col("metadata_id").alias("linked_id")),
    ))
    rows = made.select("source_key", "target_uri", "date", "payload_digest", "refers_to", pair.alias("r"))
    return rows.select("source_key", "target_uri", "date", "payload_digest", "refers_to", "r.*").select(
        "source_key", *RECORDS[:-2], digest(F.col("block")).alias("block_digest"), "payload_digest", "linked_id",
        F.octet_length("block").cast("bigint").alias("content_length"),
    )


def record_text(kind: str = "WARC/1.1") -> Column:
    """A record as it stands in a file, but for the two line ends that close it."""
    header = F.concat_ws(
        "\r\n", F.lit(kind),
        *[F.concat(F.lit(f"{name}: "), F.col(column).cast("string")) for name, column in (
            ("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"),
            ("WARC-Concurrent-To", "linked_id"), ("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"),
            ("WARC-Block-Digest", "block_digest"), ("WARC-Payload-Digest", "payload_digest"),
            ("Content-Type", "content_type"), ("Content-Length", "content_length"),
        )],
    )
    return F.concat(header, F.lit("\r\n\r\n"), "block")


def write_warc(records: DataFrame, path: str) -> None:
    """Records as gzipped WARC files, one for each partition."""
    lines = records.select(record_text().alias("value"))
    lines.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)
