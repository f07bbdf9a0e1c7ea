"""Collocations by Toivonen's mining: frequent phrases of 2 to `LONGEST` words in each language, and how well their parts hold
together.

Words are counted once and exactly. A sample of the documents, a share `SHARE` of them however many there are, then proposes
the phrases that reach two fifths of their share of `least` in it, level by level. The full pass counts what was proposed together
with the negative border: phrases that were not proposed, but whose two parts of one word less are. Every border phrase that
occurs is met that way without being listed first. Where one of them turns out to be frequent, it joins the proposed ones, and a further pass counts
the phrases that only now lie inside the border, until there are no more such failures. What is then frequent is so by exact counts,
and complete: the parts of a frequent phrase are frequent.

Tasks tell what lies inside the border by filters of bounded size (`bits`). A filter may pass phrases it should not, which are then
counted for nothing. It never holds one back, and it passes or fails all occurrences of a phrase alike, so results do not
depend on it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bits import Filter, filter_of
from .words import fold, mix, texts, written

LONGEST = 4
SHARE = 8  # one of so many documents is in the sample
SLICE_BYTES = 1 << 21  # text that a task looks at at once, or one longer text
CHUNK = 1 << 20  # words that a task counts at once
KNOWN_WORDS = 200_000  # words of which a task keeps the count
UNKNOWN = "und"
SCORE = 2_000_000
# A-Z lower-cased, the bytes that end a piece as line feed, tab as blank.
PIECES = bytes(10 if b in b".,;:!?\n\v\f\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
BREAK = 0  # the id of the end of a piece
PHRASE = [f"w{i}" for i in range(1, LONGEST + 1)]
FACTOR = 0x9E3779B97F4A7C15
FACTORS = [pow(FACTOR, k + 1, 1 << 64) for k in range(LONGEST)]


# --- words as ids -------------------------------------------------------------------


def powers(factor: int, n: int) -> np.ndarray:
    made = np.full(n, factor, np.uint64)
    made[:1] = 1
    return np.multiply.accumulate(made)


class Slices:
    """Words of texts by their hashes, which differ between languages, some texts at a time."""

    def __init__(self):
        self.up, self.down = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.seeds: dict[str, int] = {}

    def of(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """`words` of a slice of the rows: language, text."""
        for batch in batches:
            held, languages, size = [], [], 0
            for language, text in zip(batch.column("language").to_pylist(), texts(batch.column("text"))):
                held.append(text)
                languages.append(language)
                size += len(text) + 1
                if size >= SLICE_BYTES:
                    yield self.words(held, languages)
                    held, languages, size = [], [], 0
            if held:
                yield self.words(held, languages)

    def words(self, held: list[bytes], languages: list[str]) -> tuple[np.ndarray, np.ndarray, bytes, np.ndarray, np.ndarray, Callable[[int], str]]:
        """ids (`BREAK` after each piece), and of each word its place among them, the bytes with begin and end, and its language."""
        raw = b"\n".join(held).translate(PIECES) + b"\n"
        data = np.frombuffer(raw, np.uint8)
        if len(data) > len(self.up):
            self.up, self.down = powers(FACTOR, len(data)), powers(pow(FACTOR, -1, 1 << 64), len(data))
        line = data == 10
        apart = line | (data == 32)
        edge = np.flatnonzero(apart[1:] != apart[:-1]) + 1
        edge = edge if apart[0] else np.append(0, edge)
        begin, end = edge[0::2], edge[1::2]
        if not len(begin):
            return np.zeros(0, np.uint64), begin, raw, begin, end, languages.__getitem__
        value = data * self.up[: len(data)]
        value[apart] = 0
        # A word's bytes as the digits of a number, of which its place in the slice is divided out.
        number = np.add.reduceat(value, begin) * self.down[begin]
        row = np.searchsorted(np.cumsum([len(t) + 1 for t in held]), begin, side="right")
        for language in languages:
            if language not in self.seeds:
                self.seeds[language] = xxhash.xxh64_intdigest(language.encode())
        seed = np.array([self.seeds[language] for language in languages], np.uint64)
        ids = np.maximum(mix(mix(number + (end - begin).astype(np.uint64)) + seed[row]), np.uint64(1))
        lines = np.cumsum(line)
        last = np.append(lines[begin[1:]] != lines[begin[:-1]], True)
        place = np.arange(len(ids)) + np.cumsum(last) - last
        spaced = np.zeros(len(ids) + int(last.sum()), np.uint64)
        spaced[place] = ids
        if len(self.seeds) > 1000:
            self.seeds.clear()
        return spaced, place, raw, begin, end, lambda at: languages[row[at]]


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Word ids of whole texts in their order, with breaks between pieces and texts."""
    held, size = [], 0
    for ids, *_ in Slices().of(batches):
        held.append(ids)
        size += len(ids)
        if size >= CHUNK:
            yield np.concatenate(held)
            held, size = [], 0
    if held:
        yield np.concatenate(held)


def _rows(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("language"), F.col(text).alias("text"))


def count_words(rows: DataFrame) -> DataFrame:
    """id, language, word, n. `rows`: language, text."""

    def made(counts: dict[int, list]) -> pa.RecordBatch:
        ids = np.fromiter(counts, np.uint64, len(counts)).view(np.int64)
        n, languages, words = zip(*counts.values())
        return pa.record_batch({
            "id": pa.array(ids), "language": pa.array(languages, pa.string()),
            "word": pa.array(words, pa.binary()).cast(pa.string()), "n": pa.array(n, pa.int64()),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, list] = {}
        for ids, place, raw, begin, end, language in Slices().of(batches):
            found, first, n = np.unique(ids[place], return_index=True, return_counts=True)
            for word, at, more in zip(found.tolist(), first.tolist(), n.tolist()):
                entry = counts.get(word)
                if entry is None:
                    counts[word] = [more, language(at), raw[begin[at] : end[at]]]
                else:
                    entry[0] += more
            if len(counts) > KNOWN_WORDS:
                yield made(counts)
                counts = {}
        if counts:
            yield made(counts)

    told = rows.mapInArrow(run, "id bigint, language string, word string, n bigint")
    return told.groupBy("id", "language", "word").agg(F.sum("n").alias("n"))


# --- phrases ------------------------------------------------------------------------


def hash_of(ids: list[np.ndarray]) -> np.ndarray:
    """Of phrases as columns of word ids."""
    joined = np.full(len(ids[0]), len(ids), np.uint64)
    for word, factor in zip(ids, FACTORS):
        joined += word * np.uint64(factor)
    return mix(joined)


def hashed(phrases: DataFrame, length: int) -> DataFrame:
    """The hashes of the phrases of one length among `phrases`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"hash": pa.array(hash_of([_ids(batch, c) for c in PHRASE[:length]]).view(np.int64))})

    return phrases.where(_is_long(length)).select(*PHRASE[:length]).mapInArrow(run, "hash bigint")


def _ids(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)


def _is_long(length: int) -> Column:
    """Phrases of a length; the words a phrase lacks are null."""
    long = F.col(PHRASE[length - 1]).isNotNull()
    return long & F.col(PHRASE[length]).isNull() if length < LONGEST else long


def count_phrases(rows: DataFrame, inside: dict[int, Filter], lengths: list[int], fresh: dict[int, Filter] | None = None) -> DataFrame:
    """w1 ... (ids, null after a phrase's end), n: how often each phrase of the `lengths` occurs whose parts of one word less
    pass their filters, `inside` by length. With `fresh`, only phrases in which some shorter phrase passes that; parts that
    themselves hold one need not pass `inside`, as they are counted at the same time."""
    sent = rows.sparkSession.sparkContext.broadcast((inside, fresh))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, fresh = sent.value
        for ids in chunks(batches):
            at = np.flatnonzero(ids != BREAK)  # where phrases of the length before start, and which of them hold a fresh one
            new = np.zeros(len(at), bool)
            for length in range(2, max(lengths) + 1):
                hashes = hash_of([ids[at + k] for k in range(length - 1)])
                if fresh and length > 2:
                    new |= fresh[length - 1].has(hashes)
                passes = inside[length - 1].has(hashes) | new
                at, new = at[passes], new[passes]
                follows = np.flatnonzero(np.diff(at) == 1)
                at, new = at[follows], new[follows] | new[follows + 1]
                counted = at[new] if fresh else at
                if length in lengths and len(counted):
                    yield _counted(ids, counted, length)

    schema = ", ".join(f"{c} bigint" for c in [*PHRASE, "n"])
    told = rows.mapInArrow(run, schema)
    return told.groupBy(*PHRASE).agg(F.sum("n").alias("n"))


def _counted(ids: np.ndarray, at: np.ndarray, length: int) -> pa.RecordBatch:
    """The different phrases of a length that start at these places, and how often."""
    _, first, n = np.unique(hash_of([ids[at + k] for k in range(length)]), return_index=True, return_counts=True)
    words = {c: pa.array(ids[at[first] + k].view(np.int64)) for k, c in enumerate(PHRASE[:length])}
    rest = {c: pa.nulls(len(first), pa.int64()) for c in PHRASE[length:]}
    return pa.record_batch(words | rest | {"n": pa.array(n.astype(np.int64))})


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, tables)


def frequent_phrases(rows: DataFrame, words: DataFrame, least: int, sampled: Column) -> DataFrame:
    """w1 ..., n of the phrases of 2 words and more that occur `least` times. `words`: w1 ..., n of the frequent words; `sampled`: the
    rows that propose."""
    names = [*PHRASE, "n"]
    bar = max(2, -(-least * 2 // (5 * SHARE)))
    inside = {1: filter_of(hashed(words, 1))}
    sample, proposed = rows.where(sampled), []
    for length in range(2, LONGEST + 1):
        found = count_phrases(sample, inside, [length]).where(F.col("n") >= bar)
        proposed.append(written(found.select(*names), f"proposed-{length}"))
        inside[length] = filter_of(hashed(proposed[-1], length))
    inside.pop(LONGEST)
    known = _union(proposed).select(*PHRASE)
    counted = count_phrases(rows, inside, list(range(2, LONGEST + 1)))
    found = [written(counted.where(F.col("n") >= least).select(*names), "frequent")]
    same = reduce(lambda a, b: a & b, [F.col(f"k.{c}").eqNullSafe(F.col(f"f.{c}")) for c in PHRASE])
    while True:
        failed = written(found[-1].alias("f").join(known.alias("k"), same, "left_anti").select(*PHRASE), "failures")
        # The longest phrases are parts of none.
        fresh = {length: filter_of(hashed(failed, length)) for length in range(2, LONGEST)}
        if not any(f.table.any() for f in fresh.values()):
            return _union(found)
        known = _union([known, failed])
        inside = {1: inside[1]} | {length: filter_of(hashed(known, length)) for length in range(2, LONGEST)}
        more = count_phrases(rows, inside, list(range(3, LONGEST + 1)), fresh).where(F.col("n") >= least).select(*names)
        # Some were counted before. What is new holds a phrase that failed, as do all phrases that hold it: those are counted too.
        more = written(more.alias("f").join(_union(found).alias("k"), same, "left_anti").select("f.*"), "frequent")
        found.append(more)
        known = _union([known, more.select(*PHRASE)])


# --- scores -------------------------------------------------------------------------


def _key(columns: list[Column]) -> list[Column]:
    """Columns of a phrase, null after its end."""
    return columns + [F.lit(None).cast("bigint")] * (LONGEST - len(columns))


def _parts(length: int, first: int, count: int) -> Column:
    return F.struct(*[c.alias(n) for c, n in zip(_key([F.col(PHRASE[first + k]) for k in range(count)]), PHRASE)])


def scored(counts: DataFrame, phrases: DataFrame) -> DataFrame:
    """w1 ..., a, l, r, score of `phrases`, the lowest-scoring cut of each. `counts`: w1 ..., n of phrases and words."""
    cuts = []
    for length in range(2, LONGEST + 1):
        cut = F.explode(F.array(*[
            F.struct(F.lit(k).alias("k"), _parts(length, 0, k).alias("left"), _parts(length, k, length - k).alias("right"))
            for k in range(1, length)
        ])).alias("cut")
        cuts.append(phrases.where(_is_long(length)).select(*PHRASE, F.col("n").alias("a"), cut))
    rows = _union(cuts).select(*PHRASE, "a", "cut.*")
    for side, name in (("left", "l"), ("right", "r")):
        rows = _with_count(rows, side, counts, name)
    # Products may pass 64 bits.
    score = F.expr(f"CAST(CAST(a AS DECIMAL(20, 0)) * {SCORE} div (CAST(l AS DECIMAL(20, 0)) + r) AS BIGINT)")
    best = rows.withColumn("score", score).groupBy(*PHRASE, "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select(*PHRASE, "a", "best.l", "best.r", "best.score")


def _with_count(rows: DataFrame, side: str, counts: DataFrame, name: str) -> DataFrame:
    named = counts.select(F.struct(*PHRASE).alias("_of"), F.col("n").alias(name))
    # Words and phrases differ in which columns are null, so the key is the filled struct.
    filled = lambda c: F.struct(*[F.coalesce(F.col(f"{c}.{w}"), F.lit(BREAK)).alias(w) for w in PHRASE])
    return rows.join(named, filled(side) == filled("_of")).drop("_of", side)


def kept(phrases: DataFrame, share: int) -> DataFrame:
    """Phrases but those inside a longer one that has `share` percent of their occurrences or more. `phrases`: w1 ..., n."""
    inner = []
    for length in range(3, LONGEST + 1):
        parts = [(at, count) for count in range(2, length) for at in range(length - count + 1)]
        part = F.explode(F.array(*[_parts(length, at, count) for at, count in parts])).alias("part")
        inner.append(phrases.where(_is_long(length)).select("n", part))
    longer = _union(inner).groupBy("part").agg(F.max("n").alias("longer"))
    filled = lambda c: [F.coalesce(F.col(f"{c}{w}"), F.lit(BREAK)) for w in PHRASE]
    same = reduce(lambda a, b: a & b, [x == y for x, y in zip(filled("p."), filled("part."))])
    inside = F.col("longer").isNotNull() & (100 * F.col("longer").cast("decimal(20,0)") >= share * F.col("n").cast("decimal(20,0)"))
    return phrases.alias("p").join(longer, same, "left").where(~inside).select("p.*")


def collocations(
    docs: DataFrame, least: int = 30, share: int = 80, top: int = 2000, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases by score, then a, then phrase.

    A-Z are lower-cased; texts are cut at `.,;:!?` and line ends into pieces, and those at blanks and tabs into words. Phrases are 2
    to 4 words of a piece that occur `least` times in the language's texts, overlaps included; null and empty texts have none, and
    a null language counts as `und`. a is a phrase's count, n that of all words of the language, l and r those of the parts
    of the cut that scores lowest, floor(2000000 * a / (l + r)), the first of equal ones. Phrases inside a longer one with `share` percent
    of their count are left out. Repeated rows count as often as they come, null ids are taken, other columns are not read, and
    an empty table gives no rows.
    """
    rows = _rows(docs, text, lang)
    words = written(count_words(rows), "words")
    totals = words.groupBy("language").agg(F.sum("n").alias("n"))
    frequent = words.where(F.col("n") >= least)
    single = frequent.select(F.col("id").alias("w1"), *[F.lit(None).cast("bigint").alias(c) for c in PHRASE[1:]], "n")
    chosen = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("language"), F.col(text).alias("text"),
        (fold(F.col(key), SHARE) == 0).alias("sampled"),
    )
    phrases = written(frequent_phrases(chosen, single, least, F.col("sampled")), "phrases")
    best = scored(single.unionAll(phrases), kept(phrases, share))
    names = frequent.select("id", "language", "word")
    first = names.select(F.col("id").alias("w1"), F.col("language"), F.col("word").alias("t1"))
    best = best.join(first, "w1")
    for c, t in zip(PHRASE[1:], ("t2", "t3", "t4")):
        best = best.join(names.select(F.col("id").alias(c), F.col("word").alias(t)), c, "left")
    best = best.select("language", F.concat_ws(" ", "t1", "t2", "t3", "t4").alias("phrase"), "a", "l", "r", "score")
    order = Window.partitionBy("language").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    best = best.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    return best.join(totals, "language").select(F.col("language").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")
