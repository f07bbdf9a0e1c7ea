"""Exact dedup, the similarity join, decontamination and mixing against brute force."""

from __future__ import annotations

import itertools
import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake.llm import components, decontaminate, exact_dedup, group_search, mixing, similarity_join
from postlake.llm.similarity_join import Measure

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [1, 2, 3, 17, 500, 4096])
def test_perfect_hash_fills_every_slot_once(n):
    digests = np.frombuffer(random.Random(n).randbytes(32 * n), np.uint8).reshape(-1, 32)
    seeds = exact_dedup.perfect_hash(digests)
    assert sorted(exact_dedup.slots(digests, seeds, n)) == list(range(n))


def test_dedup_against_a_history(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "PART_DIGESTS", 5)
    rng = random.Random(2)
    rows = [(i, rng.choice([None, "", *"abcdefgh", *(f"text {k}" for k in range(60))]), rng.random() < 0.5) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, old boolean")
    groups = {}
    for i, text, _ in rows:
        groups.setdefault(text or "", []).append(i)
    for history in (F.col("old"), F.lit(True), F.lit(False), F.lit(None).cast("boolean")):
        made = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(docs, history).collect()}
        assert made == {i: (max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""])) for i, t, _ in rows}


def groups_by_hand(rows, words, least):
    sets = {}
    for i, text in rows:
        w = (text or "").split()
        n = min(words, len(w))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= least * (len(sets[a]) + len(sets[b]) - common):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(seed, sizes):
    """Chains and stars of edited copies of all sizes, near the threshold on both sides."""
    rng = random.Random(seed)
    texts = [None, "", "one", "one", "one two"]
    for size in sizes:
        base = [f"w{rng.randrange(size * 3)}" for _ in range(size)]
        texts.append(" ".join(base))
        for _ in range(6):
            if rng.random() < 0.5:
                base = list(base)
            copy = base if rng.random() < 0.4 else list(base)
            for _ in range(rng.randint(0, 1 + size // 40)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = [f"x{rng.randrange(9)}"]
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("words, least, block, heavy", [(3, 90, 1 << 22, None), (5, 80, 2000, None), (5, 80, 9000, 4), (3, 90, 500, 14)])
def test_similarity_join_loses_no_link(spark, monkeypatch, words, least, block, heavy):
    """Whatever the size of blocks, and with hardly any or many light sets."""
    monkeypatch.setattr(group_search, "BLOCK_BYTES", block)
    if heavy:
        monkeypatch.setattr(similarity_join, "first_heavy", lambda counts, measure: heavy)
    rows = near_copies(words, [4, 6, 9, 10, 11, 12, 15, 20, 22, 30, 45, 60, 90, 150, 300])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similarity_join.similar_groups(docs, Measure(words, least)).collect()}
    expected = groups_by_hand(rows, words, least)
    assert made == expected
    assert sum(i != root for i, (_, root) in expected.items()) > 20


@pytest.mark.parametrize("measure", [Measure(3, 90), Measure(5, 80), Measure(5, 50)])
@pytest.mark.parametrize("heavy", [2, 10, 16])
def test_sets_that_link_share_keys(measure, heavy):
    """One subset, or as many listed elements as either needs, wherever the boundary is."""
    rng = np.random.default_rng(heavy)
    linking = 0
    for size in (2, 3, 4, 5, 8, 9, 10, 12, 13, 15, 17, 19, 28, 40, 61, 140):
        for _ in range(60):
            one = np.unique(rng.integers(0, 1 << 62, size, np.uint64))
            gone = int(rng.integers(0, max(1, size // 2)))
            other = np.unique(np.concatenate([one[gone:], rng.integers(0, 1 << 62, int(rng.integers(0, 4)), np.uint64)]))
            common = len(np.intersect1d(one, other))
            if len(one) != common or len(other) != common:
                if 100 * common >= measure.least * (len(one) + len(other) - common):
                    linking += 1
                    (a, b), (c, d) = (similarity_join.keys_of(s, heavy, measure) for s in (one, other))
                    if max(len(one), len(other)) < heavy:
                        assert set(a) & set(c)
                    else:
                        assert len(set(b) & set(d)) >= max(measure.needed(len(one)), measure.needed(len(other)))
    assert linking > 40


def test_a_passage_alone_is_looked_at_by_no_list(spark):
    """Texts of which a sixth is in common do not meet."""
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(i, f"{passage} " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(250))) for i in range(60)]
    made = similarity_join.sets(spark.createDataFrame(rows, "doc_id long, text string"), 10, Measure(5, 80))
    assert group_search.meeting(similarity_join.key_lists(made)).isEmpty()


def test_boundary_follows_the_cost():
    measure = Measure(3, 90)
    few, many = ({n: count for n in range(64)} for count in (1, 10_000_000))
    assert similarity_join.first_heavy({}, measure) == measure.first == 9
    assert measure.first <= similarity_join.first_heavy(few, measure) < similarity_join.first_heavy(many, measure) < 64


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(1000, 3), (3, 3), (55, 55)]
    rng = random.Random(1)
    edges = [e if rng.random() < 0.5 else e[::-1] for e in edges]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 40)} | {3: 3, 1000: 3}


def distance_by_hand(item, words):
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_decontamination_equals_the_edit_matrix(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(7)]
    items = [(i, [rng.choice(vocabulary) for _ in range(rng.randint(0, 24))]) for i in range(25)]
    texts = []
    for i in range(60):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        copy = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, 6)):
            if copy:
                copy[rng.randrange(len(copy)) :][:1] = []
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
                if rng.random() < 0.3:
                    del copy[rng.randrange(len(copy))]
        at = rng.randint(0, len(text))
        texts.append((i, text[:at] + copy + text[at:]))
    expected = {}
    for (d, text), (i, item) in itertools.product(texts, items):
        least = distance_by_hand(item, text)
        if item and least <= len(item) // 5 and least < len(item):
            expected[d, i] = least
    docs = spark.createDataFrame([(d, ", ".join(t).upper()) for d, t in texts], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontaminate.find_items(docs, bench).collect()}
    assert found == expected and len(set(expected.values())) > 2
    left = {r["doc_id"] for r in decontaminate.without_items(docs, bench).collect()}
    assert left == {d for d, _ in texts} - {d for d, _ in expected}


def test_items_in_several_blocks_are_all_found(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    once = sorted(map(tuple, decontaminate.find_items(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 300)
    assert once and sorted(map(tuple, decontaminate.find_items(docs, bench).collect())) == once


def test_permutations_are_permutations():
    for size in (1, 2, 3, 5, 64, 100, 1000):
        for key in (0, 1, 12345):
            index = np.arange(size)
            assert sorted(mixing.permuted(index, np.full(size, size), np.full(size, key))) == list(range(size))


def targets_by_hand(sizes):
    weights = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    target, open_, left = {}, dict(weights), float(sum(sizes.values()))
    while open_:
        share = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        stopped = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not stopped:
            return target | share
        for s in stopped:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            del open_[s]
    return target


def test_mix_follows_its_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 8)
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 50)
    rng = random.Random(6)
    rows = []
    for i in range(400):
        source = rng.choice([None, "b", "b", "b", "é", "a", "zz", "z", "none"])
        size = 0 if source == "none" else rng.randint(0, 40) if source != "zz" else 1
        rows.append((i, rng.choice([" ", "\n\t"]).join(["w"] * size) if size else rng.choice([None, "", " "]), source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    made = mixing.mix_sources(docs).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    target = targets_by_hand(sizes)
    taken = Counter()
    for r in made:
        source, text = rows[r["doc_id"]][2], rows[r["doc_id"]][1]
        assert r["size"] == len((text or "").split()) and r["source_size"] == sizes[source]
        assert abs(r["target"] - target[source]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 3 * 8 for s in sizes)
    again = mixing.mix_sources(docs.repartition(5)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, made))


def test_slots_take_blocks_evenly(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 64)
    import pandas as pd

    plan = pd.DataFrame({"source": ["a", "b", "c"], "source_size": [256 * 10, 256 * 100, 256 * 7 - 5], "rank": [0, 1, 2], "target": [256 * 30.0, 256 * 40.0, 256 * 14.0]})
    rows = mixing.slots(spark, plan, 1).collect()
    blocks, quota = mixing._quotas(plan)
    by_rank = Counter(r["rank"] for r in rows)
    assert [by_rank[k] for k in range(3)] == list(quota)
    for k in range(3):
        ordinals = sorted(r["ordinal"] for r in rows if r["rank"] == k)
        assert ordinals == list(range(quota[k]))
        times = Counter(r["block"] for r in rows if r["rank"] == k)
        assert max(times.values()) <= -(-quota[k] // blocks[k]) and set(times) <= set(range(blocks[k]))
    shards = Counter(r["shard"] for r in rows)
    assert all(n == 64 for s, n in shards.items() if s != max(shards))


def test_pipeline_equals_its_stages_by_hand(spark):
    """Copies, near copies and contaminated texts of a small corpus."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    last = {}
    for i in sorted(rows):
        last[rows[i]] = i
    lower = {i: rows[i].lower() for i in last.values()}
    groups = groups_by_hand(sorted(lower.items()), 5, 80)
    left = {i for i, (_, root) in groups.items() if i == root}
    items = [decontaminate.plain_words(r["text"].encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i for i in left if not any(
        b" ".join(item[:3]) in (t := b" ".join(decontaminate.plain_words(rows[i].encode()))) and distance_by_hand(item, t.split()) <= len(item) // 5 for item in items)}
    made = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(made) == clean and len(clean) < len(left) < len(rows)
    assert sum(r["size"] for r in made.values()) == sum(len(rows[i].encode().split()) for i in clean)


def test_pipeline_keeps_one_of_near_copies(spark):
    """By five-word shingles and four fifths; three words and nine tenths would keep them all."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").dropDuplicates(["text"])
    rows = sorted((r["doc_id"], (r["text"] or "").lower()) for r in docs.collect())
    groups = groups_by_hand(rows, 5, 80)
    left = {i for i, (_, root) in groups.items() if i == root}
    assert {r["doc_id"] for r in corpus_pipeline.one_of_similar(spark, docs, SF).collect()} == left and len(left) < len(rows)


def test_sketches_rule_out_no_link_but_texts_that_share_a_passage():
    rng = np.random.default_rng(8)
    for size in (10, 63, 64, 65, 300, 3000):
        one = np.unique(rng.integers(0, 1 << 62, size, np.uint64))
        for gone in (0, size // 20, size // 9, size // 2):
            fresh = rng.integers(0, 1 << 62, size // 15, np.uint64)
            other = np.unique(np.concatenate([one[gone:], fresh]))
            pair = [one, other]
            if (similarity_join.linked(pair, 80) == 0).all():
                assert (similarity_join.may_link([similarity_join.sketch(x) for x in pair], 80) == 0).all()
    passage = rng.integers(0, 1 << 62, 150, np.uint64)
    apart = [np.unique(np.concatenate([passage, rng.integers(0, 1 << 62, 150, np.uint64)])) for _ in range(20)]
    assert list(similarity_join.may_link([similarity_join.sketch(x) for x in apart], 80)) == list(range(20))
