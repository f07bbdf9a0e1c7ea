"""The corpus pipeline: stages over `documents`, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm.decontaminate import without_items
from postlake.llm.exact_dedup import exact_dedup
from postlake.llm.language import keep_known, learn
from postlake.llm.mixing import mix_sources
from postlake.llm.similarity_join import Measure, similar_groups
from postlake.llm.words import fold, read, written

# Mean posterior, over a text's words, of each word's likeliest language, below which the text is rejected.
LEAST_LANGUAGE = 0.5


def _match(docs: DataFrame, rows: DataFrame, hashed: Column, how: str) -> DataFrame:
    """Documents that are, or are not, among `rows` by id, null or not, and by a hash of their text; ids alone may repeat. The
    rows are written first: if their table turns out small, no document has to move."""
    rows = written(rows.toDF("_id", "_hash"), "rows")
    return docs.join(rows, docs["doc_id"].eqNullSafe(rows["_id"]) & (hashed == rows["_hash"]), how)


def _is_history() -> Column:
    return F.pmod(F.col("doc_id"), F.lit(2)) == 0


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose words are of known languages stay, mixed ones too; without any labelled text to learn from, all texts with a letter.
    Null and empty texts go. Each row is judged by its text alone: equal texts share their fate, null ids and repeats change nothing."""
    model = learn(docs, fold(F.col("doc_id"), 3) != 1)
    return keep_known(docs, model, LEAST_LANGUAGE) if model else docs.where(F.col("text").rlike(r"\p{L}"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays; where a row repeats id and text, one of them. Null counts as empty; of
    equal texts whose ids are all null one stays. Texts of one id are told apart by a 64-bit hash."""
    found = exact_dedup(docs, _is_history())
    # Texts whose ids are all null have no winner.
    stays = (F.col("kept") | F.col("keep_id").isNull()).alias("stays")
    found = written(found.select("doc_id", F.xxhash64("text_sha256").alias("h"), stays), "dedup")
    gone = found.where("NOT stays").select("doc_id", "h")
    again = found.where("stays").groupBy("doc_id", "h").count().where("count > 1").drop("count")
    hashed = F.xxhash64(F.sha2(F.coalesce(docs["text"], F.lit("")), 256))
    once = _match(docs, gone.unionAll(again), hashed, "left_anti")
    return once.unionAll(_match(docs, again, hashed, "left_semi").dropDuplicates(["doc_id", "text"]))


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that link, directly or through others, the one with the smallest id stays: five-word shingles, four fifths. Null ids
    come last; of several texts of the smallest id that link, the one of the smallest hash stays. Null, empty and blank texts
    link with nothing and stay. A row that repeats id and text shares its fate."""
    groups = similar_groups(docs, Measure(words=5, least=80))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    # Only components of several texts have to be looked at, which are few rows.
    first = groups.where("component IS NOT NULL").groupBy(F.col("component").alias("_component")).agg(
        F.min(order).alias("_first"), F.max(order).alias("_last")
    )
    first = first.where("_first <> _last").drop("_last")
    linked = groups.join(first, F.col("component") == F.col("_component"))
    gone = linked.where(order != F.col("_first")).select("doc_id", "text_hash")
    return _match(docs, gone, F.xxhash64(F.coalesce(docs["text"], F.lit(""))), "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in which no benchmark item occurs stay, null and empty ones among them; null and empty items occur nowhere. Each row is
    judged by its text alone, so ids, null or repeated, change nothing."""
    return without_items(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes. Null texts have no words and take none; a null source is a source of its
    own; rows that repeat id and text may swap what they take."""
    return mix_sources(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("exact dedup", drop_copies),
    ("similarity join", one_of_similar),
    ("decontamination", drop_contaminated),
    ("mixing sources", mix),
]

# The stages learn models and search for near copies, which SQL cannot express; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
