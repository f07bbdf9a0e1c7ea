"""Toivonen's mining against counting everything."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from postlake.llm import bits, collocations
from postlake.llm.collocations import frequent_phrases


def lists_by_hand(rows, least, share, top):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    counts = {p: n for p, n in counts.items() if n >= least}
    made = {}
    for (lang, *words), a in counts.items():
        if len(words) < 2:
            continue
        score, k, left, right = min(
            (2_000_000 * a // (counts[lang, *words[:k]] + counts[lang, *words[k:]]), k, counts[lang, *words[:k]], counts[lang, *words[k:]])
            for k in range(1, len(words))
        )
        longer = [n for (other, *w), n in counts.items() if other == lang and len(w) > len(words) and
                  any(w[i : i + len(words)] == words for i in range(len(w)))]
        if not any(100 * n >= share * a for n in longer):
            made.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, totals[lang], -score)
        for lang, found in made.items() for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


def corpus(seed, n=250):
    """Few words, so that phrases of all lengths repeat; passages, pieces of all ends, odd blanks."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(25)] + ["É", "é", "X", "x", "-"]
    passage = "we take no part in this. Nor, we Hope, do they".split()
    rows = [(1, None, "en"), (2, "", None), (3, " \t.,;\n", "de"), (None, "we take no part in", None)]
    for i in range(n):
        made = []
        for _ in range(rng.randint(1, 12)):
            made += passage if rng.random() < 0.3 else [rng.choice(words) + rng.choice(["", "", ".", ", ", "!\n", " "])]
        rows.append((10 + i, rng.choice([" ", "  ", "\t", "\n"]).join(made), rng.choice(["en", "en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("least, share, top, chunk, size", [(5, 80, 2000, 1 << 21, 1 << 22), (3, 50, 7, 40, 1), (8, 100, 2000, 100, 4)])
def test_lists_equal_counting_everything(spark, monkeypatch, least, share, top, chunk, size):
    """Filters of 64 or 256 bits let nearly all phrases pass, which changes nothing."""
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    monkeypatch.setattr(bits, "FILTER_WORDS", size)
    rows = corpus(least)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    made = sorted(tuple(r) for r in collocations.collocations(docs, least, share, top).collect())
    expected = lists_by_hand(rows, least, share, top)
    assert made == expected and len(made) > 20 and {len(r[2].split(" ")) for r in expected} >= {2, 4}


def test_what_the_sample_misses_is_found_by_further_passes(spark, monkeypatch):
    """The sample holds none of the frequent phrases of three and four words, which a further pass counts together."""
    text = "a b c d"
    rows = [(i, "a b" if i < 4 else text, "en") for i in range(44)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, language string")
    words = collocations.count_words(docs).where("n >= 10")
    single = words.select("id", "n").withColumnRenamed("id", "w1").selectExpr("w1", "CAST(NULL AS BIGINT) w2", "CAST(NULL AS BIGINT) w3", "CAST(NULL AS BIGINT) w4", "n")
    passes = []
    count = collocations.count_phrases
    monkeypatch.setattr(collocations, "count_phrases", lambda rows, inside, lengths, fresh=None: passes.append((lengths, bool(fresh))) or count(rows, inside, lengths, fresh))
    found = frequent_phrases(docs, single, 10, docs["doc_id"] < 4).collect()
    assert sorted((sum(r[c] is not None for c in collocations.PHRASE), r["n"]) for r in found) == [(2, 40), (2, 40), (2, 44), (3, 40), (3, 40), (4, 40)]
    assert passes == [([2], False), ([3], False), ([4], False), ([2, 3, 4], False), ([3, 4], True)]


def test_a_filter_holds_no_member_back(spark, monkeypatch):
    hashes = collocations.mix(np.arange(1, 5000, dtype=np.uint64))
    rows = spark.createDataFrame([(int(h),) for h in hashes[:3000].view(np.int64)], "hash long")
    for most, passing in ((1 << 22, 0.05), (16, 1.0)):
        monkeypatch.setattr(bits, "FILTER_WORDS", most)
        passed = bits.filter_of(rows).has(hashes)
        assert passed[:3000].all() and passed[3000:].mean() <= passing
    assert not bits.filter_of(rows.limit(0)).has(hashes).any()


def test_products_past_64_bits_are_exact(spark):
    n = 9_000_000_000_000_000_000
    row = "w1 bigint, w2 bigint, w3 bigint, w4 bigint, n bigint"
    counts = spark.createDataFrame([(2, None, None, None, n), (3, None, None, None, n - 1)], row)
    phrases = spark.createDataFrame([(2, 3, None, None, n - 2)], row)
    found = collocations.scored(counts, collocations.kept(phrases, 80)).first()
    assert (found["l"], found["r"], found["score"]) == (n, n - 1, 2_000_000 * (n - 2) // (2 * n - 1))
