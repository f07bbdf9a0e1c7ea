"""Merkle manifest of a dataset: a tree over the rows of each group, and one over the groups.

While a level has several nodes, every `FAN` consecutive ones (the last run may have fewer, even one) become the hash of their
hashes, joined as hexadecimal text. Witnesses grow as leaves are appended: a `Frontier` holds the open runs of each level, and
completing a run extends the witness of every leaf below it by its siblings there.

Rows are put in order by ranges, never a group in one task, and fall into aligned blocks of `BLOCK` leaves. Each block is a
frontier of its own. Its root is an append to the next round's block, until each group has one node, and the groups' nodes are
appended likewise. Then the rounds are walked down again: a block takes the witness of its root and extends it for its leaves.
So a leaf's witness is built where the leaf is, and only witnesses of blocks are stored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .words import fold, written

FAN = 8
LEVELS = 4  # of a block
BLOCK = FAN**LEVELS
ROWS_A_PART = 1_000_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Step = tuple[bytes, bytes]  # the siblings to the left and to the right


def digest(data: bytes) -> bytes:
    return sha256(data).hexdigest().encode()


class Frontier:
    """Leaves appended one by one: the open runs of each level, and each leaf's witness as far as its runs are complete."""

    def __init__(self):
        self.open: list[list[tuple[bytes, int, int]]] = [[]]
        self.witnesses: list[list[Step]] = []

    def append(self, leaf: bytes) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self._push(0, (leaf, at, at + 1))

    def _push(self, level: int, node: tuple[bytes, int, int]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)
        if len(self.open[level]) == FAN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        for k, (_, first, end) in enumerate(run):
            step = (b"".join(n[0] for n in run[:k]), b"".join(n[0] for n in run[k + 1 :]))
            for witness in self.witnesses[first:end]:
                witness.append(step)
        self._push(level + 1, (digest(b"".join(n[0] for n in run)), run[0][1], run[-1][2]))

    def close(self, levels: int) -> bytes:
        """The root `levels` above the leaves; runs still open count as complete. Only for so many leaves as fit below it."""
        for level in range(levels):
            if self.open[level]:
                self._complete(level)
        return self.open[levels][0][0]


def levels_of(size: int) -> int:
    """Levels that a block of a tree of `size` nodes rises."""
    levels = 0
    while size > 1 and levels < LEVELS:
        size = -(-size // FAN)
        levels += 1
    return levels


def folded(leaf: bytes, witness: list[Step]) -> bytes:
    """The root that a leaf and its witness give."""
    for left, right in witness:
        leaf = digest(left + leaf + right)
    return leaf


def packed(witness: list[Step]) -> bytes:
    return b"".join(bytes((len(left) // 64, len(right) // 64)) + left + right for left, right in witness)


def unpacked(data: bytes) -> list[Step]:
    steps, at = [], 0
    while at < len(data):
        left, right = data[at] * 64, data[at + 1] * 64
        steps.append((data[at + 2 : at + 2 + left], data[at + 2 + left : at + 2 + left + right]))
        at += 2 + left + right
    return steps


# --- numbering ----------------------------------------------------------------------


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """`rows` with `at`, the place of each in its `tree` by `order`, and `size`, the number of rows in the tree. No order may tie.

    Ranges of the whole order are sorted apart; a row's place is that in its range and the rows of its tree in the ranges before,
    of which only counts are gathered, by tree and range.
    """
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_A_PART))
    ranged = rows.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            tree = batch.column("tree").dictionary_encode()
            codes, names = tree.indices.to_numpy(), tree.dictionary.to_pylist()
            starts = np.flatnonzero(np.diff(codes, prepend=-1))
            first = np.repeat(starts, np.diff(starts, append=len(codes)))
            nth = np.arange(len(codes), dtype=np.int64) - first
            if names[codes[0]] == last:
                nth[codes == codes[0]] += count
            last, count = names[codes[-1]], int(nth[-1]) + 1
            columns = {c: batch.column(c) for c in batch.schema.names}
            yield pa.record_batch(columns | {"part": pa.array(np.full(len(nth), part, np.int64)), "nth": pa.array(nth)})

    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    placed = written(ranged.mapInArrow(number, f"{schema}, part bigint, nth bigint"), name)
    counts = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "tree", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"), F.sum("rows").over(tree).alias("size")
    )
    joined = placed.join(written(offsets, "offsets"), ["tree", "part"])
    return joined.withColumn("at", F.col("offset") + F.col("nth")).drop("part", "nth", "offset")


# --- rounds -------------------------------------------------------------------------


def _blocks(nodes: DataFrame, schema: str, finish) -> DataFrame:
    """`finish(tree, block, size, witness, rows, frontier)` for each block; rows with a negative `at` bring the block's own
    witness. `nodes`: tree, at, block, size, digest and what else the rows need."""
    by = ["tree", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows, given = None, [], None
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                here = (row["tree"], row["block"])
                if here != last:
                    made += _closed(last, rows, given, finish)
                    last, rows, given = here, [], None
                if row["at"] < 0:
                    given = row
                else:
                    rows.append(row)
            if made:
                yield pa.RecordBatch.from_pylist(made, out)
        made = _closed(last, rows, given, finish)
        if made:
            yield pa.RecordBatch.from_pylist(made, out)

    out = pa.schema([(n, _TYPES[t]) for n, t in (c.split() for c in schema.split(", "))])
    return nodes.repartition(*by).sortWithinPartitions(*by, "at").mapInArrow(run, schema)


_TYPES = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}


def _closed(block, rows: list[dict], given: dict | None, finish) -> list[dict]:
    if not rows:
        return []
    frontier = Frontier()
    for row in rows:
        frontier.append(row["digest"].encode())
    root = frontier.close(levels_of(rows[0]["size"]))
    return finish(*block, root, rows, frontier.witnesses, given)


def _rise(nodes: DataFrame) -> DataFrame:
    """The nodes of the next round: tree, at, size, digest."""

    def finish(tree, block, root, rows, witnesses, given) -> list[dict]:
        return [{"tree": tree, "at": block, "size": -(-rows[0]["size"] // BLOCK), "digest": root.decode()}]

    blocks = nodes.select("tree", "at", "size", "digest", F.expr(f"at div {BLOCK}").alias("block"))
    return _blocks(blocks, "tree string, at bigint, size bigint, digest string", finish)


def _descend(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """tree, at, digest, witness, subroot, root of a round's nodes, given these of the round above."""

    def finish(tree, block, root, rows, witnesses, given) -> list[dict]:
        ends = {k: given[k] for k in ("subroot", "root")}
        return [
            {"tree": tree, "at": r["at"], "digest": r["digest"], "witness": packed(w) + given["witness"]} | ends
            for r, w in zip(rows, witnesses)
        ]

    return _blocks(_with_above(nodes.select("tree", "at", "size", "digest"), above), _WITNESSED, finish)


_WITNESSED = "tree string, at bigint, digest string, witness binary, subroot string, root string"


def _with_above(nodes: DataFrame, above: DataFrame) -> DataFrame:
    own = nodes.withColumn("block", F.expr(f"at div {BLOCK}"))
    given = above.select("tree", F.lit(-1).cast("bigint").alias("at"), F.col("at").alias("block"), "witness", "subroot", "root")
    return own.unionByName(given, allowMissingColumns=True)


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of each round, from `nodes` to those that are alone in their tree."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("size")).first()[0] or 0) > 1:
        rounds.append(written(_rise(rounds[-1]), "nodes"))
    return rounds


def _walk_down(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """Witnesses of the nodes of the first of some rounds, given those of the last."""
    for nodes in reversed(rounds):
        top = written(_descend(nodes, top), "witnesses")
    return top


def manifest(leaves: DataFrame) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256 (of the witness), folded_root (of the `shown` leaf, or the leaf if that is null, with
    the leaf's witness) and verified (it is the root).

    `leaves`: group, key, leaf and shown (hexadecimal). Groups are ordered by their text, null first; leaves of a group by key, null
    first, ties by the leaf. Equal leaves of one key come in any order, which changes nothing but which of them has which witness.
    """
    # Text that orders as the groups do and has no null.
    tree = F.coalesce(F.concat(F.lit("="), F.col("group").cast("string")), F.lit("-"))
    rows = leaves.select(
        tree.alias("tree"), "key", F.unhex("leaf").alias("leaf"), F.unhex("shown").alias("shown"),
        F.monotonically_increasing_id().alias("tie"),
    )
    rows = numbered(written(rows, "leaves"), ["key", "leaf", "tie"], "ordered-leaves")
    rows = rows.select("tree", "key", "at", "size", F.lower(F.hex("leaf")).alias("digest"), F.lower(F.hex("shown")).alias("shown"))

    rounds = _rounds(rows)
    groups = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    groups = written(numbered(groups, ["name"], "ordered-groups"), "groups")
    above = _rounds(groups.select("tree", "at", "size", "digest"))
    end = above[-1].select("tree", "at", F.lit(b"").alias("witness"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    tops = _walk_down(above[:-1], end) if len(above) > 1 else end
    roots = groups.alias("g").join(tops.alias("t"), F.col("g.at") == F.col("t.at")).select(
        F.col("g.name").alias("tree"), F.lit(0).cast("bigint").alias("at"), "t.witness", F.col("g.digest").alias("subroot"), "t.root"
    )
    # The first round's witnesses are made and used where the leaves are.
    blocks = _walk_down(rounds[1:-1], roots)

    def finish(tree, block, root, rows, witnesses, given) -> list[dict]:
        rest, made = unpacked(given["witness"]), []
        for row, own in zip(rows, witnesses):
            witness = own + rest
            found = folded((row["shown"] or row["digest"]).encode(), witness).decode()
            made.append({
                "key": row["key"], "leaf": row["digest"], "subroot": given["subroot"], "root": given["root"],
                "proof_sha256": sha256(b"".join(left + right for left, right in witness)).hexdigest(),
                "folded_root": found, "verified": found == given["root"],
            })
        return made

    schema = "key bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _blocks(_with_above(rows, blocks), schema, finish)


# --- documents ----------------------------------------------------------------------


def leaf_of(values: list[Column]) -> Column:
    """Hash of some values, each as its length in bytes, a colon and its text, `-` if null."""
    shown = [value.cast("string") for value in values]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in shown
    ]), 256)


def document_manifest(docs: DataFrame) -> DataFrame:
    """Rows of `manifest` for documents by language, key as doc_id, where a third of them (by crc32 of the id, a null id counting
    as empty text) is shown with the text's A-Z lower-cased. One row for each row of `docs`, repeated ones and empty or null
    texts too; columns but `FIELDS` are not read. An empty table gives no rows."""
    values = {c: F.col(c) for c in FIELDS}
    lower = values | {"text": F.translate("text", UPPER, LOWER)}
    leaves = docs.select(
        F.col("lang").alias("group"), F.col("doc_id").cast("bigint").alias("key"), leaf_of(list(values.values())).alias("leaf"),
        F.when(fold(F.col("doc_id"), 3) == 0, leaf_of(list(lower.values()))).alias("shown"),
    )
    return manifest(leaves).withColumnRenamed("key", "doc_id")
