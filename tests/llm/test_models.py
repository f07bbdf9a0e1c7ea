"""The learned operators: exact parts by brute force, the rest by held-out results."""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake.llm import language, pitman_yor, toxicity
from postlake.llm.catalog import QUERIES

SF = "/root/testdata/sf0.01"


def test_forward_backward_equals_all_labellings():
    rng = np.random.default_rng(0)
    model = language.Model(["a", "b", "c"], np.zeros((1, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
    lengths = np.array([1, 4, 2, 4])
    scores = rng.normal(size=(lengths.sum(), 3))
    post = language.forward_backward(scores, lengths, model)[0]
    at = 0
    for n in lengths:
        total = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            weight = model.starts[path[0]] + sum(scores[at + i, k] for i, k in enumerate(path))
            weight += sum(model.moves[a, b] for a, b in zip(path, path[1:]))
            for i, k in enumerate(path):
                total[i, k] += math.exp(weight)
        assert np.allclose(post[at : at + n], total / total.sum(axis=1, keepdims=True))
        at += n


def test_languages_of_held_out_texts(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op5_language"](spark, SF).collect()]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) / len(out) > 0.97


def test_words_of_switched_texts(spark):
    samples = [("en", b"the house and the dog is not that it was for this"), ("de", "die Straße und der Hund ist nicht für das Haus".encode())] * 20
    model = language.fit(samples)
    docs = spark.createDataFrame([(1, "the dog was not for this und die Straße ist nicht das Haus"), (2, None)], "doc_id long, text string")
    rows = sorted(language.label_words(docs, model).collect(), key=lambda r: r["first_word"])
    assert [(r["doc_id"], r["first_word"], r["words"], r["lang"]) for r in rows] == [(1, 0, 6, "en"), (1, 6, 7, "de")]


def test_learning_from_nothing():
    assert language.fit([("en", b""), ("de", b"123")]) is None
    assert language.predict(None, [b"text"])[0] == ["und"]
    model = toxicity.fit([])
    assert len(model.weights) == 0 and model.bias == 0


def test_toxicity_logits_are_a_factorization_machine():
    rng = np.random.default_rng(1)
    model = toxicity.Model(np.arange(6), 0.3, rng.normal(size=6), rng.normal(size=(6, toxicity.FACTORS)))
    texts = [np.array([0, 2, 5]), np.array([], np.int64), np.array([1])]
    flat, owner = toxicity._flat(texts)
    made = toxicity._logits(model, flat, owner, 3)[0]
    for terms, value in zip(texts, made):
        pairs = sum(model.vectors[a] @ model.vectors[b] for a, b in itertools.combinations(terms, 2))
        assert math.isclose(value, 0.3 + model.weights[terms].sum() + pairs)


def test_pairs_of_terms_decide_what_single_ones_cannot():
    words = [b"insult", b"group"]
    samples = []
    for k in range(400):
        mark = k % 4 == 3
        text = b" ".join([w for i, w in enumerate(words) if k >> i & 1] + [b"other%d" % (k % 7)])
        samples.append((int(mark), toxicity.Terms().of(text)))
    model = toxicity.fit(samples)
    score = {t: toxicity._logits(model, *toxicity._flat([toxicity.Terms(model.places).of(t)]), 1)[0][0] for t in (b"insult", b"group", b"insult group")}
    assert score[b"insult group"] > 0 > max(score[b"insult"], score[b"group"])


def test_toxicity_of_held_out_texts(spark):
    data = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op3_toxicity"](spark, data).collect()]
    assert all(r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    out = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    count = Counter(out)
    assert count[1, 1] / (count[1, 1] + count[0, 1]) > 0.85
    assert count[0, 0] / (count[0, 0] + count[1, 0]) > 0.99


@pytest.mark.parametrize("part_tokens", [1_000_000, 40_000])
def test_language_model_counts_and_base_scores(spark, monkeypatch, part_tokens):
    """One part and many, the latter with hot words."""
    monkeypatch.setattr(pitman_yor, "PART_TOKENS", part_tokens)
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    texts = {r["doc_id"]: r["text"].encode().lower().split() + [None] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    counts = Counter(w for i, t in texts.items() if not held[i] for w in t)
    total, distinct = sum(counts.values()), len(counts)
    rows = pitman_yor.score_documents(docs).collect()
    assert len(rows) == len(texts)
    sums = Counter()
    for r in rows:
        tokens = texts[r["doc_id"]]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[w] > 0 for w in tokens), total)
        assert r["held_out"] == held[r["doc_id"]]
        if r["held_out"]:
            sums.update(tokens=len(tokens), base=r["base_score"], model=r["score"])
    # Perplexity on held-out texts, well below that of the unigrams.
    assert 10 ** (-sums["model"] / sums["tokens"]) < 0.5 * 10 ** (-sums["base"] / sums["tokens"])


@pytest.mark.parametrize("part_tokens", [1_000_000, 3_000])
def test_every_context_has_a_restaurant_of_its_own(spark, monkeypatch, part_tokens):
    """Each of 20,000 words is always followed by the same one: true contexts tell which, however many there are."""
    monkeypatch.setattr(pitman_yor, "PART_TOKENS", part_tokens)
    texts = [" ".join(f"a{i} b{i}" for i in range(k, k + 10)) for k in range(0, 20_000, 10)]
    held = [i for i in range(20_000) if zlib.crc32(str(i).encode()) % 10 == 0]
    learnt = [i for i in range(20_000) if zlib.crc32(str(i).encode()) % 10]
    rows = [(i, texts[k % 2000]) for k, i in enumerate(learnt[:6000])]
    rows += [(held[0], "a7 b7"), (held[1], "a7 b17"), (held[2], "b7 a8")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    score = {r["doc_id"]: r["score"] for r in pitman_yor.score_documents(docs).where("held_out").collect()}
    right, wrong = score[held[0]], score[held[1]]
    assert right - wrong > 3
    model = {r["doc_id"]: r for r in pitman_yor.score_documents(docs.where(F.col("doc_id") != held[2])).collect()}
    ones = [r["score"] / r["n_tokens"] for i, r in model.items() if not r["held_out"]]
    # A token is one of 2,000 at the start of a text and nearly certain after it; shared restaurants leave it one of ten.
    assert np.mean(ones) > -0.45


def seated_by_hand(texts, held, rounds=3):
    """The model on one machine with dictionaries, one customer after the other; log10 probability of all held-out tokens."""
    rng = np.random.default_rng(11)
    data = Counter((u, w) for t, out in zip(texts, held) if not out for u, w in zip(["<"] + t, t))
    ones, twos = (sum(n == k for n in data.values()) for k in (1, 2))
    discount = ones / (ones + 2 * twos)
    root = Counter(w for _, w in data)
    few = [sum(n == k for n in root.values()) for k in (1, 2)]
    low = few[0] / (few[0] + 2 * few[1])
    size, customers = len(root), Counter()
    for (u, _), n in data.items():
        customers[u] += n
    tables, root_tables = dict.fromkeys(data, 1), dict.fromkeys(root, 1)
    kept = []
    for turn in range(1, rounds + 1):
        by_context, guests, seats = Counter(), sum(root.values()), sum(root_tables.values())
        for (u, _), n in tables.items():
            by_context[u] += n
        chance = lambda w: (root[w] - low * root_tables.get(w, 0) + (1 + low * seats) / (size + 1)) / (1 + guests)  # noqa: E731,B023
        made = {}
        for (u, w), n in data.items():
            t, weight = 1, (1 + discount * by_context[u]) * chance(w)
            for k in range(1, n):
                t += rng.random() < weight / (k - discount * t + weight)
            made[u, w] = t
        tables, root = made, Counter()
        for (_, w), n in made.items():
            root[w] += n
        root_tables = {}
        for w, n in root.items():
            t, weight = 1, (1 + low * seats) / (size + 1)
            for k in range(1, n):
                t += rng.random() < weight / (k - low * t + weight)
            root_tables[w] = t
        if turn > 1:
            by_context, guests, seats = Counter(), sum(root.values()), sum(root_tables.values())
            for (u, _), n in tables.items():
                by_context[u] += n
            kept.append((tables, by_context, root, dict(root_tables), guests, seats))
    total = 0
    for t, out in zip(texts, held):
        for u, w in zip(["<"] + t, t) if out else ():
            p = 0
            for tables, by_context, root, root_tables, guests, seats in kept:
                base = (root[w] - low * root_tables.get(w, 0) + (1 + low * seats) / (size + 1)) / (1 + guests)
                own = data[u, w] - discount * tables[u, w] if (u, w) in data else 0
                p += (own + (1 + discount * by_context[u]) * base) / (1 + customers[u]) / len(kept)
            total += math.log10(p)
    return total


@pytest.mark.parametrize("part_tokens", [1_000_000, 5_000])
def test_held_out_scores_equal_a_model_on_one_machine(spark, monkeypatch, part_tokens):
    monkeypatch.setattr(pitman_yor, "PART_TOKENS", part_tokens)
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(400)
    rows = docs.collect()
    texts = [r["text"].encode().lower().split() + [None] for r in rows]
    expected = seated_by_hand(texts, [zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in rows])
    made = [r for r in pitman_yor.score_documents(docs.repartition(3)).where("held_out").collect()]
    assert sum(r["score"] for r in made) == pytest.approx(expected, rel=0.002)


def test_postings_take_few_bytes_a_token(spark, monkeypatch):
    """However many parts there are; neither words nor contexts of a pair, nor which documents are held out, are kept again and again."""
    monkeypatch.setattr(pitman_yor, "PART_TOKENS", 5_000)
    folders, make = [], pitman_yor.run_folder
    monkeypatch.setattr(pitman_yor, "run_folder", lambda *a: folders.append(make(*a)) or folders[-1])
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{k}" for k in rng.zipf(1.3, 300))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tokens = sum(r["n_tokens"] for r in pitman_yor.score_documents(docs).collect())
    assert tokens == 600 * 301
    files = Path(folders[-1].removeprefix("file:")).rglob("*.parquet")
    size = sum(f.stat().st_size for f in files)
    assert size < 4 * tokens


def test_postings_of_a_chunk_come_back_by_part():
    rng = np.random.default_rng(7)
    each = [rng.integers(0, 60, n).astype(np.uint64) * pitman_yor.GOLDEN for n in rng.integers(1, 40, 30)]
    held = (np.arange(30) % 3 == 0).tolist()
    hot = np.sort(np.arange(1, 5, dtype=np.uint64) * pitman_yor.GOLDEN)
    layout = pitman_yor.Layout(7, 5, 2, hot, np.arange(1, 5, dtype=np.uint64), 1, np.arange(12) % 3)
    batches = list(pitman_yor._chunk(90, list(range(30)), held, each, layout))
    rows = [r for b in batches for r in b.to_pylist()]
    about = next(r for r in rows if r["part"] < 0)
    assert sorted(about["ids"]) == list(range(30)) and about["held"] == [held[i] for i in about["ids"]]
    assert about["tokens"] == [len(each[i]) for i in about["ids"]]
    found, expected = Counter(), Counter()
    for r in rows:
        if r["part"] >= 0:
            postings, *parts = pitman_yor.unpack(r["blob"])
            assert (postings.base, postings.n_docs, postings.n_trained) == (90, 30, 20)
            for part, p in postings.split(*parts):
                words, contexts = np.repeat(p.words, p.sizes), p.keys[p.at]
                assert set(layout.part_of(words, contexts).tolist()) == {part} and layout.lead[part] == r["part"]
                assert len(np.unique(p.at)) == len(p.keys) and len(np.unique(p.words)) == len(p.words)
                found.update(zip(words.tolist(), contexts.tolist(), p.docs.tolist()))
    for k, i in enumerate(about["ids"]):
        coded = layout.coded(each[i]).tolist()
        expected.update((w, c, k) for c, w in zip([int(pitman_yor.START)] + coded, coded))
    assert found == expected


def test_a_task_tells_only_of_documents_that_had_tokens():
    """Not of all documents of each chunk, of which it may have met few."""
    scores = pitman_yor.Scores()
    chunks = [np.arange(50) * 9_000, np.full(50, 8_000)]
    for k in range(50):
        scores.sum_up(chunks, np.array([k * 8_000 + 5, k * 8_000 + 7_999, k * 8_000 + 5]), np.array([0.1, 0.2, 0.3]), -np.ones(3), np.ones(3))
    assert [list(np.flatnonzero(scores.sums[base][2])) for base in (0, 9_000, 441_000)] == [[5, 7_999]] * 3
    assert scores.sums[9_000][:, 5] == pytest.approx([0.4, -2, 2])
    told = scores.told()
    assert told.num_rows == 50 and sum(len(b.as_py()) for b in told.column("blob")) < 50 * 150


def test_probabilities_of_all_words_add_up_to_one():
    rng = np.random.default_rng(4)
    words, contexts = np.arange(5, 45, dtype=np.uint64), np.arange(6)
    table = rng.poisson(0.7, (len(words), len(contexts)))
    table[:, 0] += 1
    pairs = [(w, c, int(table[w, c])) for w in range(len(words)) for c in contexts if table[w, c]]
    counts = pitman_yor.Counts(
        words, np.array([next(i for i, p in enumerate(pairs) if p[0] == w) for w in range(len(words))]),
        *(np.array([p[k] for p in pairs]) for k in range(3)))
    first = pitman_yor._first_sums(counts)
    k = pitman_yor.CONTEXTS
    model = pitman_yor.Model(int(first[k : 2 * k].sum()), len(words), 0.6, 0.4)
    model.rounds.append(pitman_yor.Totals(first[:k], first[k : 2 * k], *first[2 * k : 2 * k + 2]))
    for turn in (1, 2, 3):
        made = pitman_yor._round_sums(counts, pitman_yor.sample(counts, model, turn, 0, 9))
        model.rounds.append(pitman_yor.Totals(made[:k], first[k : 2 * k], *made[k:]))
    known = pitman_yor.predictive(counts, model, 0, 9)
    unknown = np.uint64(3)
    for context in range(len(contexts)):
        scores = pitman_yor.Scores()
        everything = np.sort(np.append(words, unknown))
        blob = pitman_yor.pack(0, np.zeros(len(everything), bool), everything, np.ones(len(everything)), np.full(len(everything), context), np.arange(len(everything)))
        scores.add(blob, known, model)
        assert math.isclose((10 ** scores.sums[0][1]).sum(), 1, rel_tol=1e-9)


def test_seating_follows_the_restaurant_rule():
    rng = np.random.default_rng(5)
    assert list(pitman_yor.seat(np.array([0, 1]), np.array([1.0, 1.0]), 0.5, rng)) == [0, 1]
    made = pitman_yor.seat(np.full(40_000, 3), np.full(40_000, 0.8), 0.5, rng)
    again = 0.8 / (1 - 0.5 + 0.8)
    third = (1 - again) * 0.8 / (2 - 0.5 + 0.8) + again * 0.8 / (2 - 1.0 + 0.8)
    assert abs(made.mean() - (1 + again + third)) < 0.02
    many = pitman_yor.seat(np.full(300, 5000), np.full(300, 2.0), 0.5, rng)
    slow = []
    for _ in range(60):
        tables = 1
        for k in range(1, 5000):
            tables += rng.random() < 2.0 / (k - 0.5 * tables + 2.0)
        slow.append(tables)
    assert abs(many.mean() - np.mean(slow)) < 0.1 * np.mean(slow)


def test_a_small_sample_keeps_the_share_of_toxic_texts(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(f"word{k}" for k in rng.integers(0, 30, 8)), int(i % 10 == 0)) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    models = []
    for sample in (4000, 150):
        monkeypatch.setattr(toxicity, "SAMPLE", sample)
        models.append(toxicity.learn(docs, docs, toxicity.F.lit(True)))
    blank = [r["score"] for m in models for r in toxicity.score(spark.createDataFrame([(1, "")], "doc_id long, text string"), m).collect()]
    assert max(blank) < 0.3 and abs(models[0].bias - models[1].bias) < 0.3


def test_text_of_no_known_language_goes_and_mixed_text_stays(spark):
    """Whatever the number of languages."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang IS NOT NULL")
    samples = {r["lang"]: r["text"] for r in docs.where("n_chars > 400").groupBy("lang").agg(F.first("text").alias("text")).collect()}
    mixed = " ".join(" ".join(text.split()[:40]) + "." for text in samples.values())
    rows = [(1, mixed), (2, None), (3, "12 34 !"), (4, "")] + [(10 + i, t) for i, t in enumerate(samples.values())]
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    for languages in (sorted(samples)[:2], sorted(samples)):
        model = language.learn(docs.where(F.col("lang").isin(languages)), F.lit(True))
        kept = {r["doc_id"] for r in language.keep_known(planted, model).collect()}
        assert 1 in kept and not kept & {2, 3, 4}
    assert {10 + i for i in range(len(samples))} <= kept
