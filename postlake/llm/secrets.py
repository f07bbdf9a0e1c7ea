"""Secret scans: candidates by their shape, false positives removed by a random forest.

Candidates are all values, of any length and characters, that are assigned to what is named as a secret or stand as the password
of a URL, and all runs of 16 or more letters, digits and + / _ - in whole texts, joined by dots if such runs are. Their features: length, shares of kinds of
characters, entropy, how likely their character transitions are in the corpus's words, how much of them dictionary words cover,
the path, and the words beside them. The dictionary and the transitions come from counts of the words of all documents.

The forest is fitted on labelled findings, at most `SAMPLE` of each label, those with the smallest hash. Where no findings are
given, `rule_labels` marks the clear cases and leaves the others to the forest.

Column expressions and Spark's own forest only: no Python on the executors.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import smallest, written

NAMES = r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api.?key|access.?key|private.?key|credentials?|auth)"
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:\.[A-Za-z0-9+/_-]{16,}+)*+={0,2}"
# The short look behind spares most places the long one. A bare value ends before closing punctuation.
VALUE = (
    r"(?<=[:=]\s{0,4}[\x22\x27\x60]?)(?<=(?i:" + NAMES + r")[^A-Za-z0-9:=]{0,8}[:=]{1,2}\s{0,4}[\x22\x27\x60]?)"
    r"(?:(?<=[\x22\x27\x60])[^\x22\x27\x60\r\n]++(?=[\x22\x27\x60])|[^\s\x22\x27\x60:=](?:[^\s\x22\x27\x60]*[^\s\x22\x27\x60.,;:!?)\]}>])?)"
)
IN_URL = r"(?<=:)(?<=://[^\s:/@]{0,64}:)[^\s/][^\s]*(?=@[A-Za-z0-9\[])"
CANDIDATE = f"{VALUE}|{IN_URL}|{RUN}"
BESIDE = 64
SAMPLE = 3000
TREES = 20
DEPTH = 6
DICTIONARY = 1000
DICTIONARY_WORD = "[a-z]{4,}"
# What secrets are called, what stands in for one, how issued ones begin, where made-up ones lie.
NAMED = "(?i)" + NAMES + r"[^A-Za-z0-9]{0,8}$"
ASSIGNED = r"[:=]\s*[\x22\x27\x60]?$"
STAND_IN = r"(?i)example|sample|dummy|placeholder|change.?me|your.?|xxxx|0000|1234567|abcdef"
ISSUED = r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|sk_live_[A-Za-z0-9]{16,})$"
MADE_UP_PATH = r"(?i)(?:^|[/_.-])(?:tests?|examples?|samples?|fixtures?|mocks?|docs?)(?:[/_.-]|$)"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
FEATURES = (
    "length", "digits", "uppers", "lowers", "marks", "distinct", "runs", "entropy", "transitions", "covered", "named", "assigned",
    "quoted", "stand_in", "beside_stand_in", "made_up_path",
)


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """doc_id, path, start (characters before it), candidate, before, after: a row for each candidate of each row."""
    raw = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), raw.alias("t"))
    rows = rows.where(F.col("t").rlike(CANDIDATE))
    rows = rows.withColumn("between", F.split("t", CANDIDATE)).withColumn("found", F.regexp_extract_all("t", F.lit(CANDIDATE), F.lit(0)))
    # A running sum: the length of what stands before each candidate.
    steps = F.zip_with(F.slice("between", 1, F.size("found")), "found", lambda b, c: F.struct(F.length(b).alias("b"), F.length(c).alias("c")))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("starts"))
    sums = F.aggregate(
        steps, start,
        lambda s, x: F.struct((s["at"] + x["b"] + x["c"]).alias("at"), F.concat(s["starts"], F.array(s["at"] + x["b"])).alias("starts")),
        lambda s: s["starts"],
    )
    each = rows.select("doc_id", "path", "between", "found", F.posexplode(sums).alias("i", "start"))
    return each.select(
        "doc_id", "path", "start", F.element_at("found", F.col("i") + 1).alias("candidate"),
        F.right(F.element_at("between", F.col("i") + 1), F.lit(BESIDE)).alias("before"),
        F.left(F.element_at("between", F.col("i") + 2), F.lit(BESIDE)).alias("after"),
    )


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """word, n: how often each word of four letters or more occurs in all documents; words are distinct here, counts exact."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(DICTIONARY_WORD), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def corpus_words(docs: DataFrame, text: str = "text") -> tuple[list[str], dict[str, float]]:
    """The most frequent words, and log probabilities of letters after letters within all words."""
    counts = written(word_counts(docs, text).where(F.length("word") < 16), "word-counts")
    top = counts.orderBy(F.desc("n"), "word").limit(DICTIONARY).collect()
    at = F.explode(F.sequence(F.lit(1), F.length("word") - 1)).alias("at")
    pairs = counts.select("word", "n", at).groupBy(F.expr("substring(word, at, 2)").alias("pair")).agg(F.sum("n").alias("n")).collect()
    total: dict[str, int] = {}
    for r in pairs:
        total[r["pair"][0]] = total.get(r["pair"][0], 0) + r["n"]
    table = {r["pair"]: math.log((r["n"] + 1) / (total[r["pair"][0]] + len(LETTERS))) for r in pairs}
    return [r["word"] for r in top], table


def _share(candidate: Column, kind: str) -> Column:
    return 1 - F.length(F.regexp_replace(candidate, kind, "")) / F.length(candidate)


def with_features(found: DataFrame, words: list[str], transitions: dict[str, float]) -> DataFrame:
    """The columns of `FEATURES`, as doubles."""
    c = F.col("candidate")
    size = F.length(c)
    chars = F.split(c, "")
    low = F.lower(c)
    kinds = F.array_distinct(chars)
    often = F.transform(kinds, lambda x: (size - F.length(F.replace(c, x, F.lit("")))) / size)
    entropy = F.aggregate(F.filter(often, lambda p: p > 0), F.lit(0.0), lambda s, p: s - p * F.log2(p))
    # Transitions that no word has, such as those with a digit, count as the least likely.
    rare = min(transitions.values(), default=0.0) - 1
    table = F.create_map(*[F.lit(x) for pair in sorted(transitions.items()) for x in pair]) if transitions else F.create_map(F.lit(""), F.lit(0.0))
    next_ones = F.slice(F.split(low, ""), F.lit(2), size)
    pairs = F.zip_with(F.slice(F.split(low, ""), F.lit(1), size - 1), next_ones, lambda a, b: F.coalesce(F.element_at(table, F.concat(a, b)), F.lit(rare)))
    likely = F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x) / F.greatest(size - 1, F.lit(1))
    known = "|".join(sorted(words, key=lambda w: (-len(w), w))) or "(?!)"
    made = {
        "length": F.log(size), "digits": _share(c, "[0-9]"), "uppers": _share(c, "[A-Z]"), "lowers": _share(c, "[a-z]"),
        "marks": _share(c, "[^A-Za-z0-9]"), "distinct": F.size(kinds) / size,
        "runs": F.regexp_count(c, F.lit("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+")) / size, "entropy": entropy,
        "transitions": likely, "covered": _share(low, known), "named": F.col("before").rlike(NAMED),
        "assigned": F.col("before").rlike(ASSIGNED), "quoted": F.col("after").rlike(r"^[\x22\x27\x60]"),
        "stand_in": c.rlike(STAND_IN), "beside_stand_in": F.concat("before", "after").rlike(STAND_IN),
        "made_up_path": F.col("path").rlike(MADE_UP_PATH),
    }
    return found.select("*", *[F.coalesce(v.cast("double"), F.lit(0.0)).alias(name) for name, v in made.items()])


def rule_labels(found: DataFrame) -> DataFrame:
    """Adds `label`: 1 for issued keys and values given to what is named as a secret, 0 for words, numbers, stand-ins and
    made-up paths, null for all others."""
    c = F.col("candidate")
    nothing = c.rlike(r"^[A-Za-z]+$|^[a-z]+(?:[-_/][a-z]+)+$|^[0-9]+$") | c.rlike(STAND_IN) | F.col("path").rlike(MADE_UP_PATH)
    something = c.rlike(ISSUED) | (F.col("before").rlike(NAMED) & F.col("before").rlike(ASSIGNED) & c.rlike("[0-9]"))
    return found.withColumn("label", F.when(nothing, 0).when(something, 1))


def train(labelled: DataFrame, seed: int = 7) -> RandomForestClassificationModel | None:
    """A forest over the columns of `FEATURES`; None unless both labels occur."""
    marked = labelled.where("label IN (0, 1)").withColumn("_hash", F.xxhash64("candidate", "before", "after"))
    few = smallest(marked, "label", ["_hash", "candidate", "before", "after"], SAMPLE)
    few = written(few.select(F.col("label").cast("double").alias("label"), *FEATURES), "labelled-findings")
    if few.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="_features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=seed)
    return forest.fit(_assembled(few))


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(rows)


def score(found: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """Adds `score`, the forest's share of votes for a secret; without a forest the label, 0 where there is none."""
    if model is None:
        return found.withColumn("score", F.coalesce(F.col("label").cast("double"), F.lit(0.0)))
    model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_votes")
    return model.transform(_assembled(found)).withColumn("score", vector_to_array("_votes")[1])


def scan_secrets(docs: DataFrame, findings: DataFrame | None = None, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """One row for each candidate: doc_id, start, candidate, score (0 to 1), secret (from 0.5 on).

    `findings` (doc_id, start, label) are labels by hand and take the place of `rule_labels`; a finding labelled twice counts with
    its larger label. Null and empty texts have no candidates, null paths count as empty. Repeated rows give repeated
    candidates. Other columns of `docs` are not read.
    """
    found = candidates(docs, key, text, path)
    if findings is None:
        found = rule_labels(found)
    else:
        marks = findings.groupBy(F.col("doc_id").alias("_doc"), F.col("start").alias("_start")).agg(F.max("label").alias("label"))
        found = found.join(marks, (F.col("doc_id") == F.col("_doc")) & (F.col("start") == F.col("_start")), "left").drop("_doc", "_start")
    made = written(with_features(found, *corpus_words(docs, text)), "secret-candidates")
    scored = score(made, train(made))
    return scored.select("doc_id", "start", "candidate", "score", (F.col("score") >= 0.5).alias("secret"))
