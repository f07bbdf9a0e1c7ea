"""License and secret scans and WARC derivatives against plain Python and the queries' SQL."""

from __future__ import annotations

import gzip
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from postlake.llm import catalog, licenses, secrets, warc

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def left_by_hand(found):
    """Word by word: the best detection takes its words if all of them are free. Detections: first, -past, priority, order."""
    taken, kept = set(), []
    for place in sorted(found, key=lambda p: (p[2], p[0] + p[1], p[0], p[3])):
        words = set(range(place[0], -place[1]))
        if not words & taken:
            taken |= words
            kept.append(place)
    return kept


def by_hand(text):
    """The license scan over a list of words."""
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = WORD.findall(text)
    norm = " " + " ".join(words) + " "
    base, found = [], []
    for order, rule in enumerate(licenses.RULES):
        if rule.keyword not in norm:
            continue
        for m in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", norm):
            first = norm[: m.start()].count(" ") - 1
            place = (first, -(first + m.group().count(" ") + 1), rule.priority, order, rule)
            found.append(place)
            if rule.base:
                base.append(place)
    kept = left_by_hand(found)
    labels = {p[4].label for p in base}
    return (
        len(words), len(base), min((p[0] for p in base), default=None), max((p[0] for p in base), default=None),
        ",".join(sorted(labels)), ",".join(sorted(labels | {p[4].label for p in kept})),
        max((p[4].confidence for p in base + kept), default=0.0),
    )


PHRASES = [
    "Released under the MIT License.", "Licensed under the Apache License, Version 2.0", "CC BY-NC 4.0", "CC BY-NC-SA 4.0 license",
    "GNU General Public License v3 or any later", "SPDX-License-Identifier: MPL", "All rights reserved", "BSD 3-Clause License",
    "licensed under the terms of the GNU Lesser General Public License version 2.1", "under the mit license under the mit license",
    "cc by nc cc by nc", "Unlicense", "license", "the Boost Software License 1.0", "É MİT ﬁ License", "public domain",
]


def test_license_scan_equals_a_scan_by_hand(spark):
    rng = random.Random(1)
    texts = [None, "", "...", *PHRASES]
    for _ in range(120):
        parts = [rng.choice([*PHRASES, "foo", "bar,", "the", "2.0"]) for _ in range(rng.randint(1, 9))]
        texts.append(rng.choice([" ", "\n", ", "]).join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in licenses.license_labels(docs).collect():
        assert tuple(row)[1:] == by_hand(texts[row["doc_id"]]), texts[row["doc_id"]]


@pytest.mark.parametrize("rules, text, left", [
    ([("aa bb", 3), ("bb cc", 2), ("cc dd", 1)], "aa bb cc dd", ["aa bb", "cc dd"]),
    ([("aa bb cc dd", 3), ("bb", 4), ("dd ee", 1)], "aa bb cc dd ee", ["bb", "dd ee"]),
    ([("aa bb cc", 2), ("bb", 2), ("cc dd", 2)], "aa bb cc dd bb", ["aa bb cc", "bb"]),
])
def test_suppressed_detections_suppress_nothing(spark, rules, text, left):
    made = tuple(
        licenses.Rule(label=p, gate=p.split()[0], keyword=p, pattern=p, priority=n, confidence=0.5, base=False) for p, n in rules
    )
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [d["label"] for d in licenses.scan_licenses(docs, made).first()["found"]] == left


def test_license_rules_hold_their_gate_and_keyword():
    assert len(licenses.RULES) > 300
    for rule in licenses.RULES:
        assert rule.gate.replace("licen", "licens") in rule.pattern.replace("licen[sc]es?", "licenses") or rule.gate in rule.pattern, rule
        assert rule.keyword in re.sub(r"\(\?:[^()]*\)\?", "", rule.pattern) or rule.keyword in rule.pattern, rule


def test_native_queries_run_no_python(spark):
    for name in ("op1_license_scan", "op4_warc_derivatives", "op7_secret_scan"):
        plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("name", catalog.ORACLE)
def test_queries_equal_their_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    made = catalog.QUERIES[name](spark, SF)
    columns = sorted(made.columns)
    expected = duck.sql(f"SELECT {', '.join(columns)} FROM ({catalog.ORACLE[name]})")
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in made.collect()))) == sorted(map(repr, expected.fetchall()))


def test_warc_files_hold_the_records(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    records = warc.derivatives(warc.responses(pages, "2024-01-01T00:00:00Z"))
    warc.write_warc(records.coalesce(1), f"{tmp_path}/out")
    (path,) = tmp_path.glob("out/*.gz")
    data, at, found = gzip.decompress(path.read_bytes()), 0, {}
    while at < len(data):
        head, _, _ = data[at:].partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        begin = at + len(head) + 4
        block = data[begin : begin + int(fields[b"Content-Length"])]
        found[fields[b"WARC-Record-ID"].decode()] = (fields, block)
        at = begin + len(block)
        assert data[at : at + 4] == b"\r\n\r\n"
        at += 4
    rows = records.collect()
    assert len(found) == len(rows) == 2 * pages.count()
    for r in rows:
        fields, block = found[r["record_id"]]
        assert block.decode() == r["block"] and fields[b"WARC-Refers-To"].decode() == r["refers_to"]
        assert fields[b"WARC-Concurrent-To"].decode() in found
        assert fields[b"WARC-Block-Digest"].decode() == r["block_digest"]


def test_secret_candidates_are_all_long_runs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = []
    pattern = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
    for r in docs.collect():
        expected += [(r["doc_id"], m.start(), m.group(), r["text"][: m.start()][-64:]) for m in pattern.finditer(r["text"])]
    made = secrets.candidates(docs)
    # What stands before a candidate ends at the candidate before it.
    found = [(r["doc_id"], r["start"], r["candidate"]) for r in made.collect()]
    assert sorted(found) == sorted(e[:3] for e in expected)
    assert all(before.endswith(b) for (*_, before), b in zip(sorted(expected), [r["before"] for r in made.orderBy("doc_id", "start").collect()]))


def test_forest_removes_false_positives_by_labelled_findings(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        key = "".join(rng.choice("0123456789abcdef") for _ in range(32))
        word = "".join(rng.choice(["tion", "ment", "the", "and", "ing"]) for _ in range(6))
        rows.append((i, f"some words token = {key} and {word} beside it", "src/main"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = secrets.candidates(docs)
    labels = found.select("doc_id", "start", F.col("candidate").rlike("[0-9]").cast("int").alias("label"))
    made = secrets.scan_secrets(docs, labels.where("doc_id % 2 = 0"))
    held_out = made.where("doc_id % 2 = 1").select("secret", F.col("candidate").rlike("[0-9]").alias("truth")).collect()
    assert len(held_out) == 400 and sum(r["secret"] == r["truth"] for r in held_out) > 390


def test_assigned_values_are_candidates_whatever_their_shape(spark):
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9PlFUP0THsR8U"
    rows = [
        (1, 'password = "Tr0ub4dor&3" here', "Tr0ub4dor&3"), (2, "run with pwd=hunter2, then stop", "hunter2"),
        (3, "at postgres://user:p@ss@host/db now", "p@ss"), (4, f"sent {jwt} along", jwt), (5, "secret: x", "x"),
        (6, 'api_key = "AAAABBBBCCCCDDDD1111&tail"', "AAAABBBBCCCCDDDD1111&tail"),
    ]
    docs = spark.createDataFrame([(i, t, "a") for i, t, _ in rows], "doc_id long, text string, source string")
    found = [(r["doc_id"], r["start"], r["candidate"]) for r in secrets.scan_secrets(docs).collect()]
    assert sorted(found) == [(i, t.index(v), v) for i, t, v in rows]
