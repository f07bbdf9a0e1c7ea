"""Bottom-k sketches against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from test_searches import groups_by_hand, near_copies

from postlake.llm import bottom_k, group_search
from postlake.llm.bottom_k import Sketch


def sketch_of(elements: np.ndarray, k: int) -> np.ndarray:
    return np.append(np.uint64(len(elements)), bottom_k.bottom(elements, k))


@pytest.mark.parametrize("words, least, block", [(5, 85, 4 << 20), (5, 80, 2000), (3, 90, 9000)])
def test_no_link_is_lost(spark, monkeypatch, words, least, block):
    monkeypatch.setattr(group_search, "BLOCK_BYTES", block)
    rows = near_copies(words + least, [4, 6, 9, 10, 12, 15, 20, 30, 45, 60, 64, 66, 90, 150, 300, 1200])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = bottom_k.near_copies(docs, Sketch(words, least)).collect()
    expected = groups_by_hand(rows, words, least)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    assert sum(i != root for i, (_, root) in expected.items()) > 20


def test_texts_that_share_a_passage_do_not_meet(spark):
    """All have a third of their shingles in common; two of them link."""
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(150))
    own = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(300)) for _ in range(60)]
    rows = [(i, f"{passage} {text}") for i, text in enumerate(own)] + [(99, f"{passage} {own[7]} end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    measure = Sketch(5, 85)
    met = group_search.meeting(bottom_k.inverted_lists(bottom_k.sketches(docs, measure))).collect()
    assert len({r["cls"] for r in met}) == 2
    found = {r["doc_id"]: r["component_id"] for r in bottom_k.near_copies(docs, measure).collect()}
    assert found == {i: i for i in range(60)} | {99: 7}


def test_estimates_rule_out_no_link():
    rng = np.random.default_rng(5)
    measure = Sketch(5, 85, 64)
    for size in (5, 40, 55, 63, 64, 65, 80, 500, 5000):
        sets = []
        for _ in range(30):
            one = np.unique(rng.integers(0, 1 << 62, size, np.uint64))
            gone, fresh = int(rng.integers(0, size // 6 + 1)), int(rng.integers(0, size // 12 + 1))
            sets.append([one, np.unique(np.concatenate([one[gone:], rng.integers(0, 1 << 62, fresh, np.uint64)]))])
        for pair in sets:
            common = len(np.intersect1d(*pair))
            links = 100 * common >= 85 * (len(pair[0]) + len(pair[1]) - common)
            met = (bottom_k.may_link([sketch_of(s, 64) for s in pair], measure) == 0).all()
            assert met or not links
            if size <= 55:
                assert met == links  # the sketches are the sets
        # All pairs at once give the same links as each pair alone.
        flat = [s for pair in sets for s in pair]
        root = bottom_k.may_link([sketch_of(s, 64) for s in flat], measure)
        assert all(root[i] in (i, i - 1) if i % 2 else root[i] == i for i in range(len(flat)))


def test_small_unions_are_estimated_by_rank():
    """Against a union's smallest values by hand."""
    rng = np.random.default_rng(6)
    for k in (4, 16):
        for _ in range(200):
            a, b = (np.unique(rng.integers(0, 90, int(rng.integers(1, 60))).astype(np.uint64)) for _ in range(2))
            held = [sketch_of(s, k) for s in (a, b)]
            small = min(len(a), len(b)), max(len(a), len(b))
            union = sorted(set(held[0][1:].tolist()) | set(held[1][1:].tolist()))[:k]
            both = set(held[0][1:].tolist()) & set(held[1][1:].tolist())
            x = len(both & set(union))
            measure = Sketch(5, 50, k)
            whole = len(a) <= k and len(b) <= k and len(np.union1d(a, b)) <= k
            wanted = 100 * small[0] >= 50 * small[1] and (100 * x >= 50 * len(union) if whole else x >= measure.shared)
            assert (bottom_k.may_link(held, measure)[1] == 0) == wanted


def test_blocks_find_what_one_search_finds(spark, monkeypatch):
    """Groups of chains and stars of integers, linked if they differ by 2, dealt to one block or many."""
    from postlake.llm.components import components

    rng = random.Random(9)
    groups = [(g, c) for g, n in ((1, 90), (2, 40), (3, 2), (4, 1)) for c in rng.sample(range(1000 * g, 1000 * g + 120), n)]
    held = spark.createDataFrame([(c, [c]) for _, c in groups] * 2, "cls long, elements array<long>")

    def search(sets):
        values, root = [int(s[0]) for s in sets], list(range(len(sets)))
        for i in range(len(values)):
            for j in range(i):
                if abs(values[i] - values[j]) == 2:
                    a, b = sorted((root[i], root[j]))
                    root = [a if r == b else r for r in root]
        return np.array(root)

    rows = spark.createDataFrame([(c, g, 8, c % 7) for g, c in groups], "cls long, root long, bytes long, weight long")
    made = []
    for block in (1 << 20, 64, 200):
        monkeypatch.setattr(group_search, "BLOCK_BYTES", block)
        links = group_search.search_groups(rows, held, search)
        made.append({r["node"]: r["root"] for r in components(links, "u", "v").collect()})
    assert made[0] == made[1] == made[2] and len(set(made[0].values())) > 10


def test_rows_without_an_id_and_repeats(spark):
    rows = [(None, "a b c d e f g h i j"), (None, "a b c d e f g h i j"), (5, None), (None, ""), (6, "x y"), (6, "x y"), (7, "X  y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((tuple(r) for r in bottom_k.near_copies(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)
    assert found == sorted(
        [(None, 6, None, True)] * 2 + [(5, 0, 5, True), (None, 0, None, True), (6, 1, 6, True), (6, 1, 6, True), (7, 1, 6, False)], key=repr
    )
