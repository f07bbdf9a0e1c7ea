"""The Merkle manifest against a tree built level by level in memory."""

from __future__ import annotations

import random
import zlib
from hashlib import sha256

import pytest

from postlake.llm import merkle
from postlake.llm.merkle import Frontier, document_manifest, folded


def sha(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def tree_by_hand(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and each leaf's siblings to the left and right, level by level."""
    level, under, paths = leaves, [[i] for i in range(len(leaves))], [[] for _ in leaves]
    while len(level) > 1:
        nodes, below = [], []
        for at in range(0, len(level), 8):
            run = level[at : at + 8]
            for k in range(len(run)):
                for i in under[at + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            nodes.append(sha("".join(run)))
            below.append([i for u in under[at : at + 8] for i in u])
        level, under = nodes, below
    return level[0], paths


def manifest_by_hand(rows):
    def leaf(row, text):
        values = [row[0], row[3], row[2], row[4], text]
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def lower(text):
        return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row, leaf(row, row[1])))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for lang in order:
        groups[lang].sort(key=lambda r: (r[0][0] is not None, r[0][0] or 0, r[1]))
        trees[lang] = tree_by_hand([h for _, h in groups[lang]])
    root, above = tree_by_hand([trees[lang][0] for lang in order])
    made = []
    for lang, ups in zip(order, above):
        for (row, h), path in zip(groups[lang], trees[lang][1]):
            siblings = path + ups
            f = leaf(row, lower(row[1])) if zlib.crc32(b"" if row[0] is None else str(row[0]).encode()) % 3 == 0 else h
            for left, right in siblings:
                f = sha(left + f + right)
            made.append((row[0], h, trees[lang][0], root, sha("".join(a + b for a, b in siblings)), f, f == root))
    return sorted(made, key=repr)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 100, 513])
def test_witnesses_grow_by_appends(n):
    leaves = [sha(str(i)) for i in range(n)]
    frontier = Frontier()
    for i, leaf in enumerate(leaves):
        frontier.append(leaf.encode())
        # So far a witness has the runs that are complete, which later appends only extend.
        before = [len(w) for w in frontier.witnesses]
        assert before[0] == sum(i + 1 >= 8**k for k in range(1, 5))
    levels = merkle.levels_of(n)
    root, paths = tree_by_hand(leaves)
    assert frontier.close(levels).decode() == root
    assert [[(a.decode(), b.decode()) for a, b in w] for w in frontier.witnesses] == paths
    assert all(folded(h.encode(), w).decode() == root for h, w in zip(leaves, frontier.witnesses))
    assert all(merkle.unpacked(merkle.packed(w)) == w for w in frontier.witnesses)


def rows_of(sizes, seed):
    rng = random.Random(seed)
    texts = [None, "", "Abc", "ÄÖ A", "x" * 5000, "same"]
    rows, at = [], 0
    for lang, size in sizes.items():
        for _ in range(size):
            at += 1
            rows.append((at, rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.random()}", lang, rng.choice([None, "a", "b"]), at % 5 or None))
    rng.shuffle(rows)
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("sizes", [
    {"en": 1}, {"en": 1, None: 1}, {None: 8, "de": 9, "en": 65, "": 64, "É": 3}, {f"l{i:02}": 1 + i % 3 for i in range(70)}, {"en": 600, "de": 200},
])
@pytest.mark.parametrize("levels", [1, 2, 4])
def test_manifest_equals_the_tree_by_hand(spark, monkeypatch, sizes, levels):
    """Blocks of one level each make many rounds."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 8**levels)
    rows = rows_of(sizes, levels)
    found = document_manifest(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == manifest_by_hand(rows)
    assert any(r["verified"] for r in found) or len(rows) < 5


def test_null_ids_ties_and_repeats(spark):
    rows = [(None, "A", "en", "s", 1), (None, "A", "en", "s", 1), (None, None, None, None, None), (4, "B", "en", "s", 1), (4, "a", "en", "s", 1)] * 4
    found = document_manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == manifest_by_hand(rows)
