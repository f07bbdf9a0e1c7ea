"""Toxicity of texts by a factorization machine over hashed terms.

A text's terms are its distinct words and the first `STEMS` bytes of each, hashed. The score is the logistic of a bias, a weight for
each term and, for each pair of terms, the product of their vectors, by which an insult weighs more beside some words than
beside others.

It is fitted on the driver from labelled documents: of each label those with the smallest hash of the id, `SAMPLE` at most, each
of which weighs as many as it stands for. Of the terms met there the `TERMS` with the largest chi-square against the label get
weights, so the model has a fixed size.
Scoring is one scan without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from .words import KNOWN_WORDS, fold, plain_words, smallest, texts

BUCKETS = 1 << 22
STEMS = (4, 5)
SAMPLE = 4000
TERMS = 8192
LEAST_CHI_SQUARE = 20.0  # of the sample's texts at the labels' true shares
FACTORS = 8
PASSES = 150
RATE = 0.1
DECAY = 5e-4
HAS_LETTER = re.compile(rb"[a-z\x80-\xff]")


@dataclass
class Model:
    places: np.ndarray  # sorted buckets that have weights
    bias: float
    weights: np.ndarray  # term
    vectors: np.ndarray  # term x factor


class Terms(dict):
    """word -> buckets of its terms, worked out once for each word a task meets; with `places`, rows of a model."""

    def __init__(self, places: np.ndarray | None = None):
        super().__init__()
        self.rows = None if places is None else {int(b): i for i, b in enumerate(places)}

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        found = ()
        if HAS_LETTER.search(word):
            found = (xxh32_intdigest(b"=" + word) % BUCKETS, *(xxh32_intdigest(b"^" + word[:n]) % BUCKETS for n in STEMS))
        if self.rows is not None:
            found = tuple(self.rows[f] for f in found if f in self.rows)
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found
        return found

    def of(self, text: bytes) -> np.ndarray:
        return np.array(sorted({f for word in set(plain_words(text)) for f in self[word]}), np.int32)


def _flat(terms: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Terms of texts one after another, and whose they are."""
    owner = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
    return np.concatenate([*terms, np.zeros(0, np.int32)]), owner


def _logits(model: Model, flat: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores before the logistic, and the sums of vectors of each text."""
    vectors = model.vectors[flat]
    sums = np.stack([np.bincount(owner, vectors[:, k], n) for k in range(FACTORS)], axis=1)
    squares = np.bincount(owner, (vectors * vectors).sum(axis=1), n)
    return model.bias + np.bincount(owner, model.weights[flat], n) + 0.5 * ((sums * sums).sum(axis=1) - squares), sums


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(samples: list[tuple[int, np.ndarray]], seed: int = 3, weighs: dict[int, float] | None = None) -> Model:
    """A model from labels and terms of texts; without any, one that scores 0.5 throughout. `weighs`: for each label how many
    texts one of the sample stands for, one if not given."""
    flat, owner = _flat([terms for _, terms in samples])
    label = np.array([x for x, _ in samples], np.float64)
    weight = np.array([(weighs or {}).get(x, 1.0) for x, _ in samples], np.float64)
    weight *= len(weight) / max(weight.sum(), 1.0)
    n, toxic = weight.sum(), (weight * label).sum()
    buckets, at = np.unique(flat, return_inverse=True)
    seen = np.bincount(at, weight[owner], len(buckets))
    bad = np.bincount(at, (weight * label)[owner], len(buckets))
    spread = seen * (n - seen) * toxic * (n - toxic)
    chi = np.divide(n * (bad * n - seen * toxic) ** 2, spread, out=np.zeros(len(seen)), where=spread > 0)
    chosen = np.sort(np.argsort(-chi, kind="stable")[:TERMS])
    chosen = chosen[chi[chosen] > LEAST_CHI_SQUARE]
    row = np.full(len(buckets), -1)
    row[chosen] = np.arange(len(chosen))
    used = row[at] >= 0 if len(at) else np.zeros(0, bool)
    flat, owner = row[at][used] if len(at) else flat, owner[used]
    rng = np.random.default_rng(seed)
    model = Model(buckets[chosen], 0.0, np.zeros(len(chosen)), rng.normal(0, 0.01, (len(chosen), FACTORS)))
    if not n:
        return model
    bias_square, squares = 1e-8, [np.full_like(x, 1e-8) for x in (model.weights, model.vectors)]
    for _ in range(PASSES):
        logits, sums = _logits(model, flat, owner, len(label))
        off = weight * (_logistic(logits) - label) / n
        on = off[owner]
        slope_w = np.bincount(flat, on, len(chosen)) + DECAY * model.weights
        pull = on[:, None] * (sums[owner] - model.vectors[flat])
        slope_v = np.stack([np.bincount(flat, pull[:, k], len(chosen)) for k in range(FACTORS)], axis=1) + DECAY * model.vectors
        bias_square += off.sum() ** 2
        model.bias -= RATE * off.sum() / np.sqrt(bias_square)
        for value, slope, square in zip((model.weights, model.vectors), (slope_w, slope_v), squares):
            square += slope * slope
            value -= RATE * slope / np.sqrt(square)
    return model


def learn(docs: DataFrame, labels: DataFrame, is_training: Column, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model from the documents marked for training whose label is 0 or 1; the larger one counts if a document has both."""
    marks = labels.where(is_training & F.col(label).isin(0, 1) & F.col(key).isNotNull())
    marks = marks.groupBy(F.col(key).alias("id")).agg(F.max(label).cast("int").alias("mark"))
    picked = smallest(marks.withColumn("h", F.xxhash64("id")), "mark", ["h", "id"], SAMPLE)
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # Ids may repeat: of their texts, too, no more are taken.
    few = smallest(rows.join(F.broadcast(picked), "id"), "mark", ["h", "t"], SAMPLE).select("mark", "t")
    ids = {r["mark"]: r["count"] for r in marks.groupBy("mark").count().collect()}
    met = {r["mark"]: r["count"] for r in rows.select("id").join(F.broadcast(picked), "id").groupBy("mark").count().collect()}
    # What both cuts left out of a label, so that the fit sees the labels' true shares at every size.
    weighs = {mark: max(1.0, ids[mark] / SAMPLE) * max(1.0, n / SAMPLE) for mark, n in met.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = Terms()
        for batch in batches:
            terms = [met.of(value).tobytes() for value in texts(batch.column("t"))]
            yield pa.record_batch({"mark": batch.column("mark"), "terms": pa.array(terms, pa.binary())})

    found = sorted((r["mark"], bytes(r["terms"])) for r in few.mapInArrow(run, "mark int, terms binary").collect())
    return fit([(mark, np.frombuffer(terms, np.int32)) for mark, terms in found], weighs=weighs)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, score (0 to 1), predicted (1 from 0.5 on).

    Null and empty texts have no terms and get the score of the bias. Other columns of `docs` are not read.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms(model.places)
        for batch in batches:
            flat, owner = _flat([known.of(value) for value in texts(batch.column("text"))])
            made = _logistic(_logits(model, flat, owner, batch.num_rows)[0])
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "score": pa.array(made, pa.float64()),
                "predicted": pa.array((made >= 0.5).astype(np.int32), pa.int32()),
            })

    return rows.mapInArrow(run, "doc_id bigint, score double, predicted int")


def toxicity_of_documents(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """Scores of all documents by a model that has seen only labels of those whose fold is not held out."""
    model = learn(docs, labels, fold(F.col("doc_id"), folds) != held_out)
    scored = score(docs, model)
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "score", "predicted")
