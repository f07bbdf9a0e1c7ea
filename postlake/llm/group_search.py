"""Searching groups of classes for links inside tasks of bounded memory, and what links mean for rows.

A class is a set of shingles that one or more rows have, named by its 64-bit hash; a group is a set of classes that may link.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bits import filter_of
from .components import components
from .words import texts, written

Search = Callable[[list[np.ndarray]], np.ndarray]
Elements = Callable[[], Callable[[bytes], tuple[int | None, np.ndarray]]]
BLOCK_BYTES = 4 << 20


def search_groups(groups: DataFrame, held: DataFrame, search: Search) -> DataFrame:
    """u, v: links that connect the classes of each group as all its links would.

    `groups`: cls, root (group), bytes (of the class's elements), weight; a row for each class of a group. `held`: cls, elements
    (64-bit values, as an array or its bytes), at least once a class. `search` gives for each of some sets, in the order of their classes, the
    number of the first one it reaches by links.

    A group of more than `BLOCK_BYTES` is dealt to blocks. Its class of the largest weight, the pivot, joins every block: what
    reaches the pivot in its own block need not meet what reaches it in another. Only the classes left over are then searched
    with all blocks, in blocks of their own. So in a group of copies of one text a set moves once or twice, however many
    there are, and a task holds two blocks at most.
    """
    sizes = groups.groupBy("root").agg(
        F.count(F.lit(1)).alias("members"), F.max_by("cls", F.struct("weight", "cls")).alias("pivot"),
        F.ceil(F.sum("bytes") / BLOCK_BYTES).cast("int").alias("blocks"),
    )
    sizes = written(sizes.where("members > 1").select("root", "pivot", F.greatest("blocks", F.lit(1)).alias("blocks")), "group-sizes")
    placed = groups.select("cls", "root").join(sizes, "root")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("cls", "root"), "blocks").cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pivots = sizes.where("blocks > 1").select(F.col("pivot").alias("cls"), "root", "pivot", each.alias("block"))
    alone = F.when(F.col("blocks") > 1, F.col("pivot")).alias("pivot")
    first = placed.select("cls", "root", alone, "block").unionByName(pivots).withColumn("other", F.lit(0))
    found = written(_searched(first, held, search), "searched")
    # A class with a root and no partner reached no pivot.
    over = found.where("v IS NULL").select(F.col("u").alias("cls"), "root")
    links = found.where("v IS NOT NULL").select("u", "v")
    if over.isEmpty():
        return links
    rest = over.groupBy("root").agg(F.count(F.lit(1)).alias("over"))
    rest = sizes.join(rest, "root").join(groups.groupBy("root").agg(F.count(F.lit(1)).alias("members")), "root")
    # The share of the group's blocks that its left-over classes fill.
    others = F.ceil(F.col("blocks") * F.col("over") / F.col("members")).cast("int")
    rest = rest.select("root", "blocks", others.alias("others"))
    other = F.pmod(F.xxhash64("root", "cls"), "others").cast("int")
    queries = over.join(rest, "root").select("cls", "root", each.alias("block"), other.alias("other"))
    asked = placed.drop("blocks").join(rest, "root").select(
        "cls", "root", "block", F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("other")
    )
    both = queries.unionByName(asked).withColumn("pivot", F.lit(None).cast("bigint"))
    return links.unionAll(_searched(both, held, search).select("u", "v"))


def _searched(placed: DataFrame, held: DataFrame, search: Search) -> DataFrame:
    """u, v, root: the links found in each root, block and other; where there is a pivot, u alone of those that do not reach it."""
    by = ["root", "block", "other"]

    def found(place: tuple, pivot: int | None, group: dict[int, bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        if len(group) < 2:
            return []
        classes = np.array(sorted(group), np.int64)
        root = search([np.frombuffer(group[c], np.uint64) for c in classes.tolist()])
        new = np.flatnonzero(root != np.arange(len(root)))
        made = [(classes[root[new]], classes[new], place[0], False)]
        if pivot is not None:
            over = classes[root != root[np.searchsorted(classes, pivot)]]
            made.append((over, over, place[0], True))
        return made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pivot, group = None, None, {}
        for batch in batches:
            made = []
            columns = (batch.column(c).to_pylist() for c in (*by, "pivot", "cls"))
            for *place, given, cls, elements in zip(*columns, _bytes(batch.column("elements"))):
                if place != last:
                    made += found(last, pivot, group)
                    last, pivot, group = place, given, {}
                group[cls] = elements
            yield _pairs(made)
        yield _pairs(found(last, pivot, group))

    # Small groups by the thousand go through one task's batches, sorted, rather than one by one.
    rows = placed.join(held, "cls").repartition(*by).sortWithinPartitions(*by)
    return rows.mapInArrow(run, "u bigint, v bigint, root bigint")


def _bytes(elements: pa.Array) -> list[bytes]:
    if not pa.types.is_list(elements.type):
        return elements.to_pylist()
    ends = np.cumsum(elements.value_lengths().to_numpy())
    values = elements.flatten().to_numpy()
    return [values[end - long : end].tobytes() for end, long in zip(ends.tolist(), np.diff(ends, prepend=0).tolist())]


def _pairs(made: list[tuple[np.ndarray, np.ndarray, int, bool]]) -> pa.RecordBatch:
    u, v, root = (np.concatenate([np.zeros(0, np.int64), *parts]) for parts in (
        [m[0] for m in made], [m[1] for m in made], [np.full(len(m[0]), m[2], np.int64) for m in made]
    ))
    alone = np.concatenate([np.zeros(0, bool), *(np.full(len(m[0]), m[3]) for m in made)])
    return pa.record_batch({"u": pa.array(u), "v": pa.array(v, mask=alone), "root": pa.array(root)})


def meeting(lists: DataFrame) -> DataFrame:
    """cls, root, weight, needed: classes that meet in one of their shortest lists, grouped by the smallest class in it, and the
    length of all lists of a class together, which is largest in the midst of near copies. Lists in which the same class is
    smallest are one group, so near copies, which share many lists, meet once.

    `lists`: cls, value, needed; a row may come more than once. Of its values, a class shares `needed` at least with any class it
    links to, so one of these is in the lists that are left when the `needed - 1` longest are not looked at. Values that no
    other class has are in the shortest lists of all.
    """
    # One shuffle, by value, serves all uses: as the filters are what Spark infers for one of them, the plans stay equal.
    each = lists.where("value IS NOT NULL AND needed IS NOT NULL").repartition("value").distinct()
    long = each.groupBy("value").agg(F.count(F.lit(1)).alias("members"), F.min("cls").alias("head")).where("members > 1")
    own = Window.partitionBy("cls", "needed")
    ranked = each.join(long, "value").select(
        "cls", "head", "needed", F.count(F.lit(1)).over(own).alias("common"), F.sum("members").over(own).alias("weight"),
        F.row_number().over(own.orderBy("members", "value")).alias("at"),
    )
    ranked = ranked.where("at <= common - needed + 1")
    return ranked.groupBy("cls", F.col("head").alias("root")).agg(F.max("weight").alias("weight"), F.max("needed").alias("needed"))


def whole_sets(docs: DataFrame, wanted: DataFrame, elements_of: Elements, key: str, text: str) -> DataFrame:
    """cls, elements of one row of each class. `wanted`: doc_id, text_hash of these rows. Tasks leave out most other rows by a filter of
    text hashes; sets are joined, not texts."""
    passing = filter_of(wanted.select("text_hash"))
    sent = docs.sparkSession.sparkContext.broadcast(passing)
    hashed = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), hashed.alias("text_hash"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing, sets = sent.value, elements_of()
        made = Batches()
        for batch in batches:
            at = np.flatnonzero(passing.has(batch.column("text_hash").to_numpy().view(np.uint64)))
            batch = batch.take(pa.array(at))
            for doc_id, hashed, value in zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist(), texts(batch.column("text"))):
                cls, elements = sets(value)
                if cls is not None and made.add(doc_id, hashed, cls, elements.tobytes()):
                    yield made.take()
        yield made.take()

    found = rows.mapInArrow(run, "doc_id bigint, text_hash bigint, cls bigint, elements binary")
    asked = wanted.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return found.join(asked, same, "left_semi").select("cls", "elements")


def linked_rows(
    docs: DataFrame, made: DataFrame, groups: DataFrame, may_link: Search, linked: Search, elements_of: Elements, key: str, text: str
) -> DataFrame:
    """The rows of `made` with their components, by links of classes that share a group.

    `made`: doc_id, text_hash, n, cls and elements (what `may_link` looks at, told at least once a class); `groups`: cls, root, weight,
    bytes of these elements. `may_link` leaves out what cannot link; what may, through others too, forms candidate
    groups, which `linked` searches with whole sets. `elements_of` makes in each task what tells class and set of a text.
    """
    sketches = made.where("elements IS NOT NULL").select("cls", "elements")
    pairs = written(search_groups(groups, sketches, may_link).distinct(), "may-link")
    candidates = written(components(pairs, "u", "v"), "candidates").select(F.col("node").alias("cls"), "root")
    # One row stands for its class.
    rows = made.join(candidates.select("cls"), "cls", "left_semi").groupBy("cls").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("row"), (8 * F.min("n")).alias("bytes")
    )
    rows = written(rows.select("cls", "bytes", "row.*"), "asked")
    held = written(whole_sets(docs, rows, elements_of, key, text), "whole-sets")
    weights = groups.groupBy("cls").agg(F.max("weight").alias("weight"))
    candidates = candidates.join(rows.select("cls", "bytes"), "cls").join(weights, "cls")
    links = written(search_groups(candidates, held, linked).distinct(), "links")
    return named_components(made.select("doc_id", "text_hash", "n", "cls"), components(links, "u", "v"))


def named_components(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """`rows` (doc_id, text_hash, n, cls) as doc_id, n_shingles, component_id, text_hash and component (its smallest class, null for an
    empty set), given the `roots` (node, root) of the classes that have a link. Null ids are passed over unless a component has no other; without a class a row is on its own."""
    named = rows.join(roots, F.col("cls") == F.col("node"), "left")
    named = written(named.select("doc_id", "text_hash", "n", F.coalesce("root", "cls").alias("component")), "components")
    # Only components of several rows have to be looked up.
    least = named.where("component IS NOT NULL").groupBy("component").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")
    )
    least = least.where("rows > 1").drop("rows")
    return named.join(least, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"), "text_hash", "component"
    )


class Batches:
    """Rows of classes and their elements, gathered to batches of bounded bytes."""

    def __init__(self, most: int = 8 << 20):
        self.most, self.rows, self.bytes = most, [], 0

    def add(self, *row) -> bool:
        """doc_id, text_hash, cls, elements; whether the batch is full."""
        self.rows.append(row)
        self.bytes += len(row[-1])
        return self.bytes >= self.most

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [(), (), (), ()]
        names = (("doc_id", pa.int64()), ("text_hash", pa.int64()), ("cls", pa.int64()), ("elements", pa.binary()))
        made = pa.record_batch({name: pa.array(c, kind) for (name, kind), c in zip(names, columns)})
        self.rows, self.bytes = [], 0
        return made
