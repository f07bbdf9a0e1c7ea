"""Near copies by bottom-k sketches: each set of shingles keeps its `k` smallest values under one hash function.

Sketches meet in inverted lists of the values they retain. Two sets of Jaccard similarity `least` or more share at least
`shared` values of their sketches, but for a chance under `MISS` for a pair (none for sets of up to `k` elements, whose sketch is
the set). So of a sketch only values in its `own - shared + 1` shortest lists need be looked at: one of these is also such a
value of the other set. A value that no other set retains counts among the shortest, so texts that have little but a passage
in common are out before anything is compared, however many have it, and long lists are hardly ever read.

Sets that meet are compared by the `k` smallest values of their sketches' union, the share of which in both estimates their
similarity; estimates too low for a link, again but for a chance under `MISS`, are out. What is left forms candidate groups,
in which the exact similarity of whole sets decides.

Equal sets are one class throughout. Only sketches, and the whole sets of classes in candidate groups, are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .group_search import linked_rows, meeting
from .similarity_join import linked, set_hash, shingles
from .words import GOLDEN, WordIds, blank_words, mix, texts, written

MISS = 1e-9
TOLD = 200_000  # classes a task remembers to have told
SKETCHES_A_BATCH = 4096


@dataclass(frozen=True)
class Sketch:
    """Shingles of `words` words, `least` percent of similarity, the `k` smallest values of a set."""

    words: int = 5
    least: int = 80
    k: int = 64

    @cached_property
    def shared(self) -> int:
        """Values that the smallest `k` of a union have from both of two sets that link, but for a chance under `MISS`. The draw is
        without replacement, of which the tail is below the binomial one."""
        p, below, x = self.least / 100, 0.0, 0
        while below + (chance := comb(self.k, x) * p**x * (1 - p) ** (self.k - x)) < MISS:
            below += chance
            x += 1
        return x

    def needed(self, n: np.ndarray) -> np.ndarray:
        """Values of its sketch that a set of `n` elements shares with that of any set it links to."""
        return np.where(100 * n <= self.least * self.k, (self.least * n + 99) // 100, self.shared)


def bottom(elements: np.ndarray, k: int) -> np.ndarray:
    """The `k` smallest hashes of a set, sorted."""
    hashed = mix(elements ^ GOLDEN)
    return np.sort(hashed if len(hashed) <= k else np.partition(hashed, k - 1)[:k])


def elements_of(measure: Sketch):
    """Makes in each task what tells the class and the set of a text."""

    def start():
        ids = WordIds()

        def tell(value: bytes) -> tuple[int | None, np.ndarray]:
            elements = shingles(ids.of(blank_words(value)), measure.words)
            return (int(set_hash(elements).astype(np.int64)) if len(elements) else None), elements

        return tell

    return start


def sketches(docs: DataFrame, measure: Sketch, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, n (size), cls (hash of the set, null if it is empty); elements (the size, then the sketch) and
    needed, told by a task for the first of the rows of a class."""
    hashed = F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash")
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), hashed, F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tell, told = elements_of(measure)(), set()
        for batch in batches:
            sizes, classes, held = [], [], []
            for value in texts(batch.column("text")):
                cls, elements = tell(value)
                sizes.append(len(elements))
                classes.append(cls)
                if cls is None or cls in told:
                    held.append(None)
                    continue
                if len(told) >= TOLD:
                    told.clear()
                told.add(cls)
                held.append(np.append(np.uint64(len(elements)), bottom(elements, measure.k)).view(np.int64))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "n": pa.array(sizes, pa.int64()),
                "cls": pa.array(classes, pa.int64()), "elements": pa.array(held, pa.list_(pa.int64())),
                "needed": pa.array(measure.needed(np.array(sizes, np.int64)).astype(np.int32)),
            })

    return rows.mapInArrow(run, "doc_id bigint, text_hash bigint, n bigint, cls bigint, elements array<bigint>, needed int")


def inverted_lists(made: DataFrame) -> DataFrame:
    """cls, value, needed: a row for each value that a class retains."""
    return made.where("elements IS NOT NULL").select("cls", F.explode(F.expr("slice(elements, 2, size(elements))")).alias("value"), "needed")


def may_link(held: list[np.ndarray], measure: Sketch) -> np.ndarray:
    """For each sketch the number of the first one it reaches by links, breadth-first; a link is assumed unless the estimate
    from the two sketches rules it out."""
    k, least, shared = measure.k, measure.least, measure.shared
    sizes = np.array([h[0] for h in held]).astype(np.int64)
    own = np.array([len(h) - 1 for h in held])
    _, flat = np.unique(np.concatenate([h[1:] for h in held]), return_inverse=True)
    missing = int(flat.max()) + 1
    table = np.full((len(held), k), missing, np.int32)
    table[np.arange(k) < own[:, None]] = flat
    place = np.full(missing + 1, -1, np.int64)
    root, queue, column = np.full(len(held), -1), [], np.arange(k)
    start = 0
    left = np.argsort(sizes, kind="stable")
    while len(left):
        if queue:
            at = queue.pop()
        else:
            while root[start] >= 0:
                start += 1
            at = start
            root[at] = at
            left = left[left != at]
        low = np.searchsorted(sizes[left], -(-sizes[at] * least // 100), side="left")
        high = np.searchsorted(sizes[left], sizes[at] * 100 // least, side="right")
        near = left[low:high]
        if not len(near):
            continue
        place[table[at, : own[at]]] = np.arange(own[at])
        found = place[table[near]]
        place[table[at, : own[at]]] = -1
        both = found >= 0
        common = both.sum(axis=1)
        # A common value's rank in the union: its places in both, less the common values before it, which count twice.
        rank = found + column - (np.cumsum(both, axis=1) - both)
        among = (both & (rank < k)).sum(axis=1)
        union = own[at] + own[near] - common
        whole = (sizes[at] <= k) & (sizes[near] <= k) & (union <= k)
        hit = np.where(whole, 100 * common >= least * union, among >= shared)
        if hit.any():
            root[near[hit]] = root[at]
            queue += near[hit].tolist()
            left = np.concatenate([left[:low], near[~hit], left[high:]])
    return root


def near_copies(docs: DataFrame, measure: Sketch = Sketch(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, n_shingles, component_id (the smallest id it reaches by links, its own included),
    kept (it is that one) and text_hash, which tells rows of one id apart.

    Words are lower-cased (A-Z) runs of anything but blanks; fewer words than a shingle has are one shingle. Null, empty and
    blank texts have empty sets and link with nothing, not even each other. Rows that repeat a text link. Null ids are passed
    over for component_id unless a component has no other; then it is null, and its rows are kept. Other columns of `docs` are
    not read.
    """
    made = written(sketches(docs, measure, key, text), "sketched")
    groups = written(meeting(inverted_lists(made)).withColumn("bytes", F.lit(8 * (measure.k + 1))), "meeting")
    found = linked_rows(
        docs, made, groups, lambda held: may_link(held, measure), lambda held: linked(held, measure.least), elements_of(measure), key, text
    )
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
