"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bottom_k import Sketch, near_copies
from .collocations import collocations
from .decontaminate import find_items
from .exact_dedup import exact_dedup
from .language import language_of_documents
from .licenses import license_labels
from .merkle import document_manifest
from .mixing import mix_sources
from .sql import ORACLE  # noqa: F401
from .pitman_yor import score_documents
from .secrets import scan_secrets
from .similarity_join import Measure, similar_groups
from .toxicity import toxicity_of_documents
from .warc import derivatives, responses
from .words import read


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(read(spark, sf_dir, "documents"))


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_of_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = derivatives(responses(read(spark, sf_dir, "pages"), "2024-01-01T00:00:00Z"))
    return made.withColumnRenamed("source_key", "page_id")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_of_documents(read(spark, sf_dir, "documents"))


def op6_similar_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(read(spark, sf_dir, "documents"), Measure(words=3, least=90))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read(spark, sf_dir, "documents"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even ids are the history, odd ids arrive."""
    return exact_dedup(read(spark, sf_dir, "documents"), F.pmod(F.col("doc_id"), F.lit(2)) == 0)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_manifest(read(spark, sf_dir, "documents"))


def op12_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(read(spark, sf_dir, "documents"), Sketch(words=5, least=85))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_language_model": op2_language_model,
    "op3_toxicity": op3_toxicity,
    "op4_warc_derivatives": op4_warc_derivatives,
    "op5_language": op5_language,
    "op6_similar_groups": op6_similar_groups,
    "op7_secret_scan": op7_secret_scan,
    "op8_mix_sources": op8_mix_sources,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_near_copies": op12_near_copies,
    "op13_collocations": op13_collocations,
}
