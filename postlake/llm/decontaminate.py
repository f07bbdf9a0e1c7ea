"""Benchmark decontamination by pigeonhole edit matching.

A test item occurs in a text if some stretch of the text's words is at most `budget` word edits away from it, a fifth of its
words. The item is split into one piece more than that, so at least one piece stands in the stretch unchanged. Pieces are found
by rolling hashes over whole texts; around each hit Myers' bit-parallel distance, over words, decides.

The items are the query set. They go to the tasks in blocks of a bounded number of words, one block per pass over the
documents; an ordinary benchmark is one block. The documents are scanned without a shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import WordIds, plain_words, texts

BUDGET = 0.2
BLOCK_WORDS = 1_000_000
SLICE_WORDS = 200_000
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
SIEVE_BITS = 20


def budget(words: int) -> int:
    return int(words * BUDGET)


def least_distance(masks: dict[int, int], size: int, words: list[int]) -> tuple[int, int]:
    """The fewest edits between the item and any stretch of `words`, and the first place where such a stretch ends.

    Myers' search: bit i of `masks[w]` tells that w is word i of the item; columns of the edit matrix are two bit vectors.
    """
    ones, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score = ones, 0, size
    best, at = size, -1
    for place, word in enumerate(words):
        equal = masks.get(word, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        plus = down | ~(horizontal | up) & ones
        minus = up & horizontal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1) & ones, (minus << 1) & ones
        up = minus | ~(vertical | plus) & ones
        down = plus & vertical
        if score < best:
            best, at = score, place
    return best, at


@dataclass
class Item:
    key: int | None
    size: int
    budget: int
    masks: dict[int, int]


@dataclass
class Block:
    """Items with the hashes of their pieces, by piece length."""

    items: list[Item] = field(default_factory=list)
    pieces: dict[int, dict[int, list[tuple[int, int]]]] = field(default_factory=dict)  # length -> hash -> (item, offset)
    sieves: dict[int, np.ndarray] = field(default_factory=dict)


class Powers:
    """Powers of the base and of its inverse, modulo 2^64, as many as were asked for."""

    def __init__(self):
        self.up = self.back = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.back = (self._made(b, 2 * n) for b in (BASE, pow(BASE, -1, 1 << 64)))
        return self.up[:n], self.back[:n]

    @staticmethod
    def _made(base: int, n: int) -> np.ndarray:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)


def sums(ids: np.ndarray, powers: Powers) -> np.ndarray:
    up, _ = powers.upto(len(ids))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids * up, dtype=np.uint64)])


def windows(run: np.ndarray, size: int, powers: Powers) -> np.ndarray:
    """Hashes of all stretches of `size` words, equal for equal stretches wherever they stand."""
    if len(run) <= size:
        return np.zeros(0, np.uint64)
    return (run[size:] - run[:-size]) * powers.upto(len(run))[1][: len(run) - size]


def prepare(rows: list[tuple[int | None, bytes]]) -> Block:
    block, ids, powers = Block(), WordIds(), Powers()
    for key, text in rows:
        words = ids.of(plain_words(text))
        if not len(words):
            continue
        edits = budget(len(words))
        masks: dict[int, int] = defaultdict(int)
        for i, word in enumerate(words.tolist()):
            masks[word] |= 1 << i
        run = sums(words, powers)
        cuts = [i * len(words) // (edits + 1) for i in range(edits + 2)]
        for begin, end in zip(cuts, cuts[1:]):
            value = int(windows(run, end - begin, powers)[begin])
            block.pieces.setdefault(end - begin, {}).setdefault(value, []).append((len(block.items), begin))
        block.items.append(Item(key, len(words), edits, dict(masks)))
    for size, hashes in block.pieces.items():
        block.sieves[size] = np.zeros(1 << SIEVE_BITS, bool)
        block.sieves[size][np.array(list(hashes), np.uint64) >> np.uint64(64 - SIEVE_BITS)] = True
    return block


class Search:
    def __init__(self, block: Block):
        self.block, self.ids, self.powers = block, WordIds(), Powers()

    def matches(self, values: Iterator[bytes]) -> Iterator[tuple[int, Item, int, int]]:
        """(text, item, edits, last word) for each text and each item that occurs in it: the fewest edits, the first place."""
        pending, size, first = [], 0, 0
        for value in values:
            pending.append(self.ids.of(plain_words(value)))
            size += len(pending[-1])
            if size >= SLICE_WORDS:
                yield from self._slice(pending, first)
                pending, size, first = [], 0, first + len(pending)
        yield from self._slice(pending, first)

    def _slice(self, each: list[np.ndarray], first: int) -> Iterator[tuple[int, Item, int, int]]:
        if not each:
            return
        words = np.concatenate(each)
        ends = np.cumsum([len(e) for e in each])
        run = sums(words, self.powers)
        wanted: dict[tuple[int, int], set[int]] = defaultdict(set)
        for size, hashes in self.block.pieces.items():
            found = windows(run, size, self.powers)
            at = np.flatnonzero(self.block.sieves[size][found >> np.uint64(64 - SIEVE_BITS)])
            owner = np.searchsorted(ends, at, side="right")
            for place, text, value in zip(at.tolist(), owner.tolist(), found[at].tolist()):
                if place + size <= ends[text]:
                    for item, offset in hashes.get(value, ()):
                        wanted[text, item].add(place - offset)
        for (text, number), begins in sorted(wanted.items()):
            yield from self._verify(first + text, self.block.items[number], sorted(begins), words, int(ends[text]) - len(each[text]), int(ends[text]))

    def _verify(self, text: int, item: Item, begins: list[int], words: np.ndarray, low: int, high: int):
        best, last = item.budget + 1, -1
        spans: list[list[int]] = []
        for begin in begins:
            span = [max(low, begin - item.budget), min(high, begin + item.size + item.budget)]
            if spans and span[0] <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], span[1])
            else:
                spans.append(span)
        for begin, end in spans:
            edits, at = least_distance(item.masks, item.size, words[begin:end].tolist())
            if edits < best:
                best, last = edits, begin + at - low
        if last >= 0:
            yield text, item, best, last


def blocks(items: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[Block]:
    """The items in blocks whose words are bounded in the mean; only one block at a time is on the driver."""
    rows = items.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    size = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, -(-size // (6 * BLOCK_WORDS)))
    for b in range(n):
        part = rows.where(F.pmod(F.xxhash64("key", "t"), F.lit(n)) == b)
        yield prepare(sorted(((r["key"], r["t"].encode()) for r in part.collect()), key=lambda x: (x[0] is None, x[0], x[1])))


def find_items(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, item_id, edits, last_word: a row for each row of `docs` and each item that occurs in it.

    `edits` is the smallest distance, `last_word` where the first such stretch ends, in words from 0. Words are lower-cased (A-Z)
    runs of letters and digits. Null and empty texts hold nothing, items without words occur nowhere; items of fewer than
    five words must stand unchanged. Repeated rows or items give repeated matches. Other columns are not read.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    found = None
    for block in blocks(items):

        def run(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            search = Search(block)
            for batch in batches:
                got = list(search.matches(texts(batch.column("text"))))
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").take(pa.array([g[0] for g in got], pa.int64())),
                    "item_id": pa.array([g[1].key for g in got], pa.int64()),
                    "edits": pa.array([g[2] for g in got], pa.int32()),
                    "last_word": pa.array([g[3] for g in got], pa.int64()),
                })

        part = rows.mapInArrow(run, "doc_id bigint, item_id bigint, edits int, last_word bigint")
        found = part if found is None else found.unionAll(part)
    return found


def without_items(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, in which no item occurs."""
    for block in blocks(items):

        def run(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            search = Search(block)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[g[0] for g in search.matches(texts(batch.column(text)))]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
