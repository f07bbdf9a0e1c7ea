"""Language of words and texts by a linear-chain conditional random field.

A word's features are its prefixes and suffixes, its n-grams and the word itself, hashed into `BUCKETS` weights for each
language; transitions between the languages of neighbouring words are learned too. Documents carry one language each, so
the training sequences are made by putting pieces of sentences of several documents together, which is where switches are
learned from. Words are labelled by their posteriors, found by forward-backward over each sentence; the posteriors of all words of
a text decide its language.

The model is fitted on the driver from `DOCS_PER_LANGUAGE` documents of each language, those with the smallest hash of the
id. Scoring is one scan without a shuffle. Scores of words are remembered in a task up to a fixed number, so its memory grows
neither with the vocabulary nor, as texts are worked off in slices, with the documents.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import KNOWN_WORDS, fold, plain_words, smallest, texts

BUCKETS = 1 << 16
DOCS_PER_LANGUAGE = 300
SEQUENCES = 6000
PIECES = 4
PIECE_WORDS = 8
PASSES = 40
RATE = 0.5
DECAY = 1e-4
SLICE_WORDS = 200_000
UNKNOWN = "und"
SENTENCE_END = re.compile(rb"[.!?\n]+")
ASCII_LETTER = re.compile(rb"[A-Za-z]")
WORD_WITH_LETTER = re.compile(rb"[a-z\x80-\xff]")


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # bucket x language
    moves: np.ndarray  # language x language
    starts: np.ndarray  # language


def has_letter(text: bytes) -> bool:
    return bool(ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def sentences(text: bytes) -> Iterator[list[bytes]]:
    """Words that hold a letter, sentence by sentence."""
    for part in SENTENCE_END.split(text):
        if words := [w for w in plain_words(part) if WORD_WITH_LETTER.search(w)]:
            yield words


def features(word: bytes) -> list[int]:
    found = [crc32(b"=" + word)]
    found += [crc32(b"^" + word[:n]) for n in (1, 2, 3)] + [crc32(b"$" + word[-n:]) for n in (1, 2, 3)]
    found += [crc32(word[i : i + n]) for n in (2, 3) for i in range(len(word) - n + 1)]
    return [f % BUCKETS for f in found]


def feature_table(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of words one after another, and where each word's begin."""
    each = [features(w) for w in words]
    begins = np.cumsum([0] + [len(e) for e in each])[:-1]
    return np.fromiter((f for e in each for f in e), np.int64), begins


def word_scores(words: list[bytes], weights: np.ndarray) -> np.ndarray:
    flat, begins = feature_table(words)
    return np.add.reduceat(weights[flat], begins, axis=0)


def forward_backward(scores: np.ndarray, lengths: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors of words, with the forward and backward messages and the local factors they come from.

    Rows are the words of sequences one after another; all sequences move one word per step, longest first.
    """
    local = np.exp(scores - scores.max(axis=1, keepdims=True))
    ahead, back = np.empty_like(local), np.ones_like(local)
    order = np.argsort(-lengths, kind="stable")
    begins = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    alive = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")
    moves = np.exp(model.moves)
    for t, n in enumerate(alive):
        rows = begins[:n] + t
        made = local[rows] * (ahead[rows - 1] @ moves if t else np.exp(model.starts))
        ahead[rows] = made / made.sum(axis=1, keepdims=True)
    for t in range(len(alive) - 2, -1, -1):
        rows = begins[: alive[t + 1]] + t
        made = (back[rows + 1] * local[rows + 1]) @ moves.T
        back[rows] = made / made.sum(axis=1, keepdims=True)
    both = ahead * back
    return both / both.sum(axis=1, keepdims=True), ahead, back, local


def switched_sequences(by_language: list[list[list[bytes]]], seed: int = 5) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words, their languages and the lengths of sequences made of pieces of sentences of one or several languages."""
    rng = np.random.default_rng(seed)
    words, labels, lengths = [], [], []
    for k in range(SEQUENCES):
        size = 0
        own = k % len(by_language)
        for piece in range(int(rng.integers(1, PIECES + 1))):
            at = own if piece == 0 or rng.random() < 0.5 else int(rng.integers(len(by_language)))
            sentence = by_language[at][int(rng.integers(len(by_language[at])))]
            cut = int(rng.integers(max(1, len(sentence) - PIECE_WORDS + 1)))
            part = sentence[cut : cut + PIECE_WORDS]
            words += part
            labels += [at] * len(part)
            size += len(part)
        lengths.append(size)
    return words, np.array(labels), np.array(lengths)


def fit(samples: list[tuple[str, bytes]]) -> Model | None:
    """A model from (language, text) pairs; None if none of them holds a word."""
    found: dict[str, list[list[bytes]]] = {}
    for language, text in samples:
        if parts := list(sentences(text)):
            found.setdefault(language, []).extend(parts)
    if not found:
        return None
    languages = sorted(found)
    words, labels, lengths = switched_sequences([found[x] for x in languages])
    known = {w: i for i, w in enumerate(dict.fromkeys(words))}
    at = np.array([known[w] for w in words])
    flat, begins = feature_table(list(known))
    owner = np.repeat(np.arange(len(known)), np.diff(np.append(begins, len(flat))))
    n = len(languages)
    model = Model(languages, np.zeros((BUCKETS, n)), np.zeros((n, n)), np.zeros(n))
    truth = np.eye(n)[labels]
    first = np.cumsum(lengths) - lengths
    inner = np.setdiff1d(np.arange(len(words)), first)  # words that have one before them in their sequence
    seen = np.zeros((n, n))
    np.add.at(seen, (labels[inner - 1], labels[inner]), 1)
    squares = [np.full_like(x, 1e-8) for x in (model.weights, model.moves, model.starts)]
    for _ in range(PASSES):
        scores = np.add.reduceat(model.weights[flat], begins, axis=0)[at]
        post, ahead, back, local = forward_backward(scores, lengths, model)
        pair = ahead[inner - 1][:, :, None] * np.exp(model.moves) * (local[inner] * back[inner])[:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        off = truth - post
        by_word = np.stack([np.bincount(at, off[:, k], len(known)) for k in range(n)], axis=1)
        by_bucket = np.stack([np.bincount(flat, by_word[owner, k], BUCKETS) for k in range(n)], axis=1)
        slopes = by_bucket / len(words), (seen - pair.sum(axis=0)) / len(words), off[first].sum(axis=0) / len(lengths)
        for value, slope, square in zip((model.weights, model.moves, model.starts), slopes, squares):
            slope = slope - DECAY * value
            square += slope * slope
            value += RATE * slope / np.sqrt(square)
    model.weights = model.weights.astype(np.float32)
    return model


def learn(docs: DataFrame, is_training: Column, key: str = "doc_id", text: str = "text", language: str = "lang") -> Model | None:
    """A model from the documents marked for training that have a language; None if there are none."""
    rows = docs.where(is_training & F.col(language).isNotNull()).select(
        F.col(language).alias("language"), F.xxhash64(F.col(key)).alias("h"), F.col(text).alias("t")
    )
    hashes = smallest(rows.select("language", "h"), "language", ["h"], DOCS_PER_LANGUAGE).distinct()
    # Ids may repeat: of their texts, too, no more are taken.
    picked = smallest(rows.join(F.broadcast(hashes), ["language", "h"]), "language", ["h", "t"], DOCS_PER_LANGUAGE)
    return fit(sorted((r["language"], (r["t"] or "").encode()) for r in picked.collect()))


class Scorer:
    """Posteriors of texts, with the scores of words remembered."""

    def __init__(self, model: Model):
        self.model, self.places = model, {}
        self.scores = np.zeros((1024, len(model.languages)))

    def of(self, words: list[bytes]) -> np.ndarray:
        fresh = [w for w in dict.fromkeys(words) if w not in self.places]
        if len(self.places) + len(fresh) > KNOWN_WORDS:
            self.places, fresh = {}, list(dict.fromkeys(words))
        if fresh:
            begin = len(self.places)
            self.places.update(zip(fresh, range(begin, begin + len(fresh))))
            if len(self.places) > len(self.scores):
                grown = np.zeros((2 * len(self.places), self.scores.shape[1]))
                grown[:begin] = self.scores[:begin]
                self.scores = grown
            self.scores[begin : len(self.places)] = word_scores(fresh, self.model.weights)
        return self.scores[np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))]

    def slices(self, values: Iterator[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of some texts at a time: mean posteriors (a row for each text, zeros without words), the posteriors of their words
        and the number of words of each."""
        words, lengths, owners, n = [], [], [], 0
        for value in values:
            for sentence in sentences(value):
                words += sentence
                lengths.append(len(sentence))
                owners.append(n)
            n += 1
            if len(words) >= SLICE_WORDS:
                yield self._posteriors(words, lengths, owners, n)
                words, lengths, owners, n = [], [], [], 0
        if n:
            yield self._posteriors(words, lengths, owners, n)

    def _posteriors(self, words: list[bytes], lengths: list[int], owners: list[int], n: int):
        if not words:
            return np.zeros((n, len(self.model.languages))), np.zeros((0, len(self.model.languages))), np.zeros(n, np.int64)
        size = np.array(lengths)
        post = forward_backward(self.of(words), size, self.model)[0]
        owner = np.repeat(owners, size)
        counts = np.bincount(owner, minlength=n)
        sums = np.stack([np.bincount(owner, post[:, k], n) for k in range(post.shape[1])], axis=1)
        return sums / np.maximum(counts, 1)[:, None], post, counts


def predict(model: Model | None, values: list[bytes]) -> tuple[list[str], np.ndarray]:
    if model is None:
        return [UNKNOWN] * len(values), np.zeros(len(values))
    means = np.concatenate([m for m, _, _ in Scorer(model).slices(iter(values))] or [np.zeros((0, 1))])
    return _decide(model, values, means)


def _decide(model: Model, values: list[bytes], means: np.ndarray) -> tuple[list[str], np.ndarray]:
    known = np.fromiter(map(has_letter, values), bool, len(values)) & (means.sum(axis=1) > 0)
    best = means.argmax(axis=1)
    names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
    return names, np.where(known, np.clip(means[np.arange(len(best)), best], 0, 1), 0.0)


def _predicted(model: Model | None, text: str, make: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for batch in batches:
            values = list(texts(batch.column(text)))
            if scorer:
                names, sure = _decide(model, values, np.concatenate([m for m, _, _ in scorer.slices(iter(values))] or [np.zeros((0, 1))]))
            else:
                names, sure = predict(None, values)
            yield make(batch, names, sure)

    return run


def identify(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, lang_pred, score (mean posterior of that language over the words).

    `und` with score 0 for texts that are null or hold no letter, and for all texts if nothing could be learned. Equal
    posteriors go to the first language by name. Other columns of `docs` are not read.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def make(batch: pa.RecordBatch, names: list[str], sure: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch({"doc_id": batch.column("doc_id"), "lang_pred": pa.array(names, pa.string()), "score": pa.array(sure, pa.float64())})

    return rows.mapInArrow(_predicted(model, "text", make), "doc_id bigint, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, whose words are of a known language: whose likeliest languages have a mean
    posterior of `least` or more over the words, each word by itself. At half, a word is likelier of its language than of
    all others together, so the rule does not turn with the number of languages, and text that mixes languages whose words
    are sure stays. Rows go whose text is null or holds no letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            values, sure = list(texts(batch.column(text))), []
            for _, post, counts in scorer.slices(iter(values)):
                owner = np.repeat(np.arange(len(counts)), counts)
                sums = np.bincount(owner, post.max(axis=1), len(counts)) if len(owner) else np.zeros(len(counts))
                sure.append(sums / np.maximum(counts, 1))
            known = np.fromiter(map(has_letter, values), bool, len(values))
            yield batch.filter(pa.array(known & (np.concatenate(sure or [np.zeros(0)]) >= least), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def label_words(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs of words of one language: doc_id, first_word, words, lang, score; words are those that hold a letter, from 0."""
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            done = 0
            ids = batch.column("doc_id")
            for _, post, counts in scorer.slices(texts(batch.column("text"))):
                owner = np.repeat(np.arange(len(counts)), counts)
                place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
                best = post.argmax(axis=1)
                new = np.ones(len(owner), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (best[1:] != best[:-1])
                begin = np.flatnonzero(new)
                size = np.diff(np.append(begin, len(owner)))
                sure = np.add.reduceat(post.max(axis=1), begin) / size if len(begin) else np.zeros(0)
                yield pa.record_batch({
                    "doc_id": ids.take(pa.array(done + owner[begin])),
                    "first_word": pa.array(place[begin], pa.int64()), "words": pa.array(size, pa.int64()),
                    "lang": pa.array([model.languages[b] for b in best[begin]], pa.string()),
                    "score": pa.array(sure, pa.float64()),
                })
                done += len(counts)

    return rows.mapInArrow(run, "doc_id bigint, first_word bigint, words bigint, lang string, score double")


def language_of_documents(docs: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """Predictions for all documents of a model that has seen only those whose fold is not held out."""
    fold_of = fold(F.col("doc_id"), folds)
    model = learn(docs, fold_of != held_out)
    return identify(docs, model).select("doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "lang_pred", "score")
