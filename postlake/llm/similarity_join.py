"""Links between texts whose sets of word shingles have a Jaccard similarity of `least` percent or more: size-aware, heavy
and light.

- Light sets, the small ones, are enumerated: two sets of a and b elements that link have c(a, b) elements in common, so they share
  a subset of that fixed size. A set's keys are its subsets of each size that a partner may ask for.
- Heavy sets, the large ones, stand in the inverted lists of their elements. An order of all elements by hash is fixed, and a set is
  listed under the first of its own, so many that linked sets have `extra` listed elements at least in common. So a set needs to be
  looked up in its shortest lists only, and texts that merely share a passage are out before they are compared: they
  share fewer listed elements than a link takes.
- The boundary between the two is chosen by cost: keys written, and list entries expected to be scanned. Light sets that may link to
  a heavy one are listed too.

Either way no link is lost. Sets that meet are compared by sketches: parities of elements by hash, two bits or more an element, whose
distance is never above that of the sets, so what they rule out cannot link. What is left forms candidate groups, in which the
exact similarity of whole sets decides (`group_search`).

Equal sets are one class throughout, and a task tells the keys of a class once, so copies are compared once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .group_search import linked_rows, meeting
from .words import GOLDEN, WordIds, blank_words, mix, texts, written

SHARED = 0.2  # assumed chance that an element of a set is also in an unrelated one, for the cost alone
BYTES_A_WORD = 6  # likewise
LOOK = 0.05  # looking at a list's entry, against writing a key, likewise
SMALL = 64  # sizes from which sets are heavy whatever the cost, as their subsets are beyond number
TOLD = 500_000  # classes a task remembers to have told
KEYS_A_BATCH = 100_000
FACTOR = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Measure:
    """What links: shingles of `words` words, `least` percent of similarity."""

    words: int = 5
    least: int = 80

    @cached_property
    def first(self) -> int:
        """The size from which a set can link to an unequal one."""
        n = 1
        while 100 * n < self.least * (n + 1):
            n += 1
        return n

    def overlap(self, n: int) -> int:
        """Elements that a set of `n` shares with any set it links to, which is no smaller than that."""
        return -(-self.least * n // 100)

    def subset_sizes(self, n: int) -> list[int]:
        """Elements that sets of `n` and of a partner's size have in common if they link, for all such sizes."""
        partners = range(self.overlap(n), 100 * n // self.least + 1)
        return sorted({-(-self.least * (n + b) // (100 + self.least)) for b in partners})

    def subsets(self, n: int) -> int:
        return sum(comb(n, c) for c in self.subset_sizes(n))

    def extra(self, n: int) -> int:
        return min(1 + n // 10, self.overlap(n))

    def listed(self, n: int) -> int:
        """How many of its elements, the first by order, a set is listed under. With the `n - overlap` that a partner may lack all
        at the front, `extra` of them are left to be in common."""
        return n - self.overlap(n) + self.extra(n)

    def needed(self, n: int) -> int:
        """Listed elements in common with any set it links to: the smaller `extra` of the two."""
        return self.extra(self.overlap(n))


def first_heavy(counts: dict[int, int], measure: Measure) -> int:
    """The size from which scanning inverted lists costs less than enumerating subsets. `counts`: sets of each size."""

    def enumerate_cost(n: int) -> float:
        return counts[n] * measure.subsets(n)

    def scan_cost(n: int) -> float:
        return counts[n] * measure.listed(n) * (1 + LOOK * counts[n] * SHARED)

    sizes = sorted(n for n in counts if measure.first <= n < SMALL)
    cost = {
        x: sum(enumerate_cost(n) if n < x else 0 for n in sizes) + sum(scan_cost(n) for n in sizes if 100 * n >= measure.least * x)
        for x in range(measure.first, SMALL + 1)
    }
    return min(cost, key=cost.get)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The set of a text's shingles as sorted 64-bit hashes; fewer words than a shingle has are one, no words none."""
    n = len(words)
    if n == 0:
        return words
    used = min(n, size)
    joined = np.full(n - used + 1, used, np.uint64)
    for k in range(used):
        joined += words[k : n - used + 1 + k] * np.uint64(pow(FACTOR, k + 1, 1 << 64))
    return np.unique(mix(joined))


def set_hash(elements: np.ndarray) -> np.uint64:
    with np.errstate(over="ignore"):
        return mix(np.array([mix(elements ^ GOLDEN).sum() + np.uint64(len(elements)) * GOLDEN], np.uint64))[0]


def keys_of(elements: np.ndarray, heavy: int, measure: Measure) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set's subsets, if it is smaller than `heavy`, and the elements it is listed under, if it may link to a set that is not:
    of one or the other it shares some with every unequal set it links to."""
    n = len(elements)
    subsets, listed = [np.zeros(0, np.uint64)], np.zeros(0, np.uint64)
    if n < measure.first:
        return subsets[0], listed
    if n < heavy:
        mixed = mix(elements + GOLDEN)
        for c in measure.subset_sizes(n):
            chosen = np.array(list(combinations(range(n), c)))
            subsets.append(mix(mixed[chosen].sum(axis=1, dtype=np.uint64) + np.uint64(c)))
    if 100 * n >= measure.least * heavy:
        k = measure.listed(n)
        listed = mix(elements ^ GOLDEN)
        listed = listed if k >= n else np.partition(listed, k - 1)[:k]
    return np.concatenate(subsets), listed


def sketch(elements: np.ndarray) -> np.ndarray:
    """The number of elements, then parities of elements by hash: a power of two of them, two or more for each element."""
    width = 1 << max(6, (2 * len(elements) - 1).bit_length())
    odd = np.bincount(((elements >> np.uint64(20)) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.append(np.uint64(len(elements)), np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64))


def elements_of(measure: Measure):
    """Makes in each task what tells the class and the set of a text."""

    def start():
        ids = WordIds()

        def tell(value: bytes) -> tuple[int | None, np.ndarray]:
            elements = shingles(ids.of(blank_words(value)), measure.words)
            return (int(set_hash(elements).astype(np.int64)) if len(elements) else None), elements

        return tell

    return start


def sets(docs: DataFrame, heavy: int, measure: Measure, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, n (size), cls (hash of the set, null if it is empty); elements (the sketch), keys (those of subsets, then those
    listed), subsets (how many are of these) and needed, told by a task for the first of the rows of a class."""
    hashed = F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash")
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), hashed, F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tell, told = elements_of(measure)(), set()
        for batch in batches:
            made, size, start = [], 0, 0

            def taken(end: int) -> pa.RecordBatch:
                n, classes, sketches, keys, subsets, needed = zip(*made)
                return pa.record_batch({
                    "doc_id": batch.column("doc_id")[start:end], "text_hash": batch.column("text_hash")[start:end],
                    "n": pa.array(n, pa.int64()), "cls": pa.array(classes, pa.int64()),
                    "elements": pa.array(sketches, pa.binary()), "keys": pa.array(keys, pa.list_(pa.int64())),
                    "subsets": pa.array(subsets, pa.int32()), "needed": pa.array(needed, pa.int32()),
                })

            for at, value in enumerate(texts(batch.column("text"))):
                cls, elements = tell(value)
                if len(elements) < measure.first or cls in told:
                    made.append((len(elements), cls, None, None, None, None))
                    continue
                if len(told) >= TOLD:
                    told.clear()
                told.add(cls)
                subsets, listed = keys_of(elements, heavy, measure)
                keys = np.concatenate([subsets, listed]).view(np.int64)
                made.append((len(elements), cls, sketch(elements).tobytes(), keys, len(subsets), measure.needed(len(elements))))
                size += len(keys)
                if size >= KEYS_A_BATCH:
                    yield taken(at + 1)
                    made, size, start = [], 0, at + 1
            if made:
                yield taken(batch.num_rows)

    columns = "n bigint, cls bigint, elements binary, keys array<bigint>, subsets int, needed int"
    return rows.mapInArrow(run, f"doc_id bigint, text_hash bigint, {columns}")


def key_lists(made: DataFrame) -> DataFrame:
    """cls, value, needed: the keys of each class. One shared key of a subset is enough."""
    told = made.where("keys IS NOT NULL").select("cls", "subsets", F.col("needed").alias("all"), F.posexplode("keys").alias("at", "value"))
    return told.select("cls", "value", F.when(F.col("at") < F.col("subsets"), 1).otherwise(F.col("all")).alias("needed"))


def linked(sets_: list[np.ndarray], least: int) -> np.ndarray:
    """For each set the number of the first one it reaches by links, breadth-first over the sets not yet reached."""
    n = len(sets_)
    sizes = np.array([len(s) for s in sets_])
    _, flat = np.unique(np.concatenate(sets_), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    root = np.full(n, -1)
    left, left_flat, left_starts = np.arange(n), flat, starts
    marked = np.zeros(int(flat.max()) + 1, bool)
    queue: list[int] = []
    while len(left):
        if queue:
            at = queue.pop()
        else:
            at = int(left[0])
            root[at] = at
            left_flat, left_starts, left = _without(left_flat, left_starts, left, sizes, np.arange(len(left)) > 0)
            if not len(left):
                break
        own = flat[starts[at] : starts[at] + sizes[at]]
        marked[own] = True
        common = np.add.reduceat(marked[left_flat], left_starts, dtype=np.int64)
        marked[own] = False
        hit = 100 * common >= least * (sizes[at] + sizes[left] - common)
        if hit.any():
            root[left[hit]] = root[at]
            queue += left[hit].tolist()
            left_flat, left_starts, left = _without(left_flat, left_starts, left, sizes, ~hit)
    return root


def _without(flat: np.ndarray, starts: np.ndarray, left: np.ndarray, sizes: np.ndarray, keep: np.ndarray):
    left_sizes = sizes[left]
    return flat[np.repeat(keep, left_sizes)], np.cumsum(left_sizes[keep]) - left_sizes[keep], left[keep]


def _folded(words: np.ndarray, width: int) -> np.ndarray:
    """Sketches, one a row, brought down to a width."""
    return np.bitwise_xor.reduce(words.reshape(len(words), -1, width), axis=1)


def may_link(held: list[np.ndarray], least: int) -> np.ndarray:
    """As `linked`, from sketches: a link is assumed unless sizes or sketches rule it out."""
    sizes = np.array([h[0] for h in held]).astype(np.int64)
    widths = np.array([len(h) - 1 for h in held])
    # Sketches of one width are a table, in which sets not yet reached stand by size.
    left, tables, place = {}, {}, np.zeros(len(held), np.int64)
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        at = at[np.argsort(sizes[at], kind="stable")]
        left[width], tables[width] = at, np.stack([held[i][1:] for i in at])
        place[at] = np.arange(len(at))
    root, queue, start = np.full(len(held), -1), [], 0
    while True:
        if queue:
            at = queue.pop()
        else:
            while start < len(held) and root[start] >= 0:
                start += 1
            if start == len(held):
                return root
            at = start
            root[at] = at
            left[widths[at]] = left[widths[at]][left[widths[at]] != at]
        for width, others in left.items():
            low = np.searchsorted(sizes[others], -(-sizes[at] * least // 100), side="left")
            high = np.searchsorted(sizes[others], sizes[at] * 100 // least, side="right")
            near = others[low:high]
            if not len(near):
                continue
            narrow = min(width, int(widths[at]))
            one = _folded(held[at][None, 1:], narrow)
            apart = np.bitwise_count(_folded(tables[width][place[near]], narrow) ^ one).sum(axis=1, dtype=np.int64)
            both = sizes[at] + sizes[near]
            common = np.minimum((both - apart) // 2, np.minimum(sizes[at], sizes[near]))
            hit = 100 * common >= least * (both - common)
            if hit.any():
                root[near[hit]] = root[at]
                queue += near[hit].tolist()
                left[width] = np.concatenate([others[:low], near[~hit], others[high:]])


def similar_groups(docs: DataFrame, measure: Measure = Measure(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, n_shingles, component_id (the smallest id it reaches by links, its own included)
    and text_hash, which tells rows of one id apart.

    Words are lower-cased (A-Z) runs of anything but blanks. Null, empty and blank texts have empty sets and link with
    nothing, not even each other. Rows that repeat a text link; null ids are passed over for component_id unless a component
    has no other. Other columns of `docs` are not read.
    """
    size = (F.octet_length(F.coalesce(F.col(text), F.lit(""))) / BYTES_A_WORD).cast("bigint").alias("size")
    small = docs.select(size).where(F.col("size") < SMALL).groupBy("size").count()
    heavy = first_heavy({int(r["size"]): r["count"] for r in small.collect()}, measure)
    made = written(sets(docs, heavy, measure, key, text), "shingle-sets")
    groups = meeting(key_lists(made))
    # A sketch's bytes from the listed elements it needs in common, which are about a twelfth of the set.
    groups = written(groups.withColumn("bytes", 24 + 6 * F.col("needed")), "meeting")
    return linked_rows(
        docs, made, groups, lambda held: may_link(held, measure.least), lambda held: linked(held, measure.least),
        elements_of(measure), key, text,
    )
