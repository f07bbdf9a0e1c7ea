"""License scans: ordered signature rules over the words of a text.

A rule is a regex over the text's words, in lower case and with one blank between them. Each has a gate, a piece of a word
that whole texts are tested for before their words are taken apart, and a keyword: only texts that contain it are searched
by the regex. Where detections overlap, the one with the better priority stays; of equal ones the
first, of those the longest, so a detection that lies within another goes. Base rules count all their places apart from that.

Column expressions only: one scan, no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters and digits of ASCII and all characters beyond it make words; A-Z are lower-cased later.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Rule:
    label: str
    gate: str  # within a word of every match
    keyword: str  # words that every match contains
    pattern: str  # over words with one blank between them
    priority: int  # the smaller the better
    confidence: float
    base: bool = False


# The one gate that is too short to be told within a word: two words.
CC_BY = "cc by"

# Phrases that always count, with their labels.
BASE = (
    Rule("mit", "license", "under the mit license", "under the mit license", 0, 1.0, True),
    Rule("apache-2", "license", "apache license version 2", "apache license version 2", 0, 1.0, True),
    Rule("cc-by-nc", CC_BY, "cc by nc", "cc by nc", 0, 1.0, True),
)

# Label, keyword, name as it is written, whether the bare name is unmistakable, versions.
FAMILIES = (
    ("mit", "mit", "mit(?: x11)?", False, ()),
    ("apache", "apache", "apache(?: software)?", False, ("1 0", "1 1", "2", "2 0")),
    ("gpl", "general public", "gnu general public", True, ("1", "1 0", "2", "2 0", "3", "3 0")),
    ("gpl", "gpl", "(?:gnu )?gpl", True, ("1", "2", "2 0", "3", "3 0")),
    ("lgpl", "lesser general public", "(?:gnu )?lesser general public", True, ("2 1", "3", "3 0")),
    ("lgpl", "library general public", "(?:gnu )?library general public", True, ("2", "2 0")),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", True, ("2", "2 1", "3", "3 0")),
    ("agpl", "affero general public", "(?:gnu )?affero general public", True, ("1", "3", "3 0")),
    ("agpl", "agpl", "(?:gnu )?agpl", True, ("3", "3 0")),
    ("gfdl", "free documentation", "(?:gnu )?free documentation", True, ("1 1", "1 2", "1 3")),
    ("mpl", "mozilla public", "mozilla public", True, ("1 0", "1 1", "2 0")),
    ("epl", "eclipse public", "eclipse public", True, ("1 0", "2 0")),
    ("cpl", "common public", "(?:ibm )?common public", True, ("1 0",)),
    ("cddl", "common development and distribution", "common development and distribution", True, ("1 0", "1 1")),
    ("eupl", "european union public", "european union public", True, ("1 0", "1 1", "1 2")),
    ("artistic", "artistic", "(?:perl )?artistic", False, ("1 0", "2 0")),
    ("bsd-2-clause", "bsd", "(?:simplified bsd|bsd 2 clause|2 clause bsd)", True, ()),
    ("bsd-3-clause", "bsd", "(?:new bsd|modified bsd|bsd 3 clause|3 clause bsd)", True, ()),
    ("bsd-4-clause", "bsd", "(?:original bsd|bsd 4 clause|4 clause bsd)", True, ()),
    ("bsd-zero", "bsd", "(?:zero clause bsd|0bsd)", True, ()),
    ("bsd", "bsd", "(?:berkeley software distribution|bsd)", False, ()),
    ("isc", "isc", "isc", False, ()),
    ("zlib", "zlib", "zlib(?: libpng)?", False, ()),
    ("bsl", "boost software", "boost software", True, ("1 0",)),
    ("unlicense", "unlicense", "(?:the )?unlicense", True, ()),
    ("wtfpl", "wtfpl", "wtfpl", True, ("2",)),
    ("psf", "python software foundation", "python software foundation", True, ("2",)),
    ("ofl", "open font", "(?:sil )?open font", True, ("1 0", "1 1")),
    ("ms-pl", "microsoft public", "microsoft public", True, ()),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal", True, ()),
    ("upl", "universal permissive", "universal permissive", True, ("1 0",)),
    ("osl", "open software", "open software", False, ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "academic free", "academic free", True, ("2 0", "2 1", "3 0")),
    ("ecl", "educational community", "educational community", True, ("1 0", "2 0")),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)?", False, ()),
    ("postgresql", "postgresql", "postgresql", False, ()),
    ("openssl", "openssl", "openssl", False, ()),
    ("php", "php", "php", False, ("3 0", "3 01")),
    ("ruby", "ruby", "ruby", False, ()),
    ("odbl", "open database", "open database", True, ("1 0",)),
    ("odc-by", "open data commons attribution", "open data commons attribution", True, ("1 0",)),
    ("pddl", "public domain dedication", "(?:open data commons )?public domain dedication(?: and)?", True, ("1 0",)),
    ("cc0", "cc0", "(?:creative commons )?cc0", True, ("1 0",)),
    ("cc-by", "cc by", "cc by", True, ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "cc by sa", "cc by sa", True, ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "cc by nd", "cc by nd", True, ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "cc by nc", "cc by nc", True, ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa", True, ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd", True, ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by", "commons attribution", "creative commons attribution", True, ("2 0", "3 0", "4 0")),
    ("cc-by-sa", "attribution share", "creative commons attribution share ?alike", True, ("2 0", "3 0", "4 0")),
    ("cc-by-nd", "attribution no", "creative commons attribution no ?deriv(?:atives|s)", True, ("2 0", "3 0", "4 0")),
    ("cc-by-nc", "attribution non", "creative commons attribution non ?commercial", True, ("2 0", "3 0", "4 0")),
    ("cc-by-nc-sa", "attribution non", "creative commons attribution non ?commercial share ?alike", True, ("3 0", "4 0")),
    ("cc-by-nc-nd", "attribution non", "creative commons attribution non ?commercial no ?deriv(?:atives|s)", True, ("3 0", "4 0")),
)

# Texts known by a sentence of their own.
SENTENCES = (
    ("mit", "free of charge to any person", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution and use in source", "redistribution and use in source and binary forms with or without modification"),
    ("bsd-3-clause", "neither the name", "neither the name of [^ ]+(?: [^ ]+){0,8} nor the names of its contributors"),
    ("zlib", "provided as is without any express", "this software is provided as is without any express or implied warranty in no event"),
    ("unlicense", "free and unencumbered", "this is free and unencumbered software released into the public domain"),
    ("gpl", "free software foundation", "under the terms of the gnu general public license as published by the free software foundation"),
    ("public-domain", "public domain", "(?:released|placed|dedicated|donated|is) (?:in|into|to) the public domain"),
    ("proprietary", "all rights reserved", "all rights reserved"),
    ("proprietary", "confidential", "(?:proprietary and confidential|confidential and proprietary)"),
)
LICENSE = "licen[sc]es?"
GIVEN = "(?:(?:dual )?licensed|released|distributed|published|provided|made available|available|redistributed|covered|governed)"
TERMS = "(?:the )?(?:terms (?:and conditions )?of (?:the )?)?(?:version [0-9]+ of (?:the )?)?"


def _longest(keyword: str) -> str:
    return CC_BY if keyword.startswith(CC_BY) else max(keyword.split(), key=len)


def _family_rules(label: str, keyword: str, name: str, plain: bool, versions: tuple[str, ...]) -> list[Rule]:
    """What is said about a license: that something is given under it, its tag, its heading and, if the name is
    unmistakable, its name alone. Other names count only beside the word license."""
    gate, word = (_longest(keyword), f"(?: {LICENSE})?") if plain else ("licen", f" {LICENSE}")
    made = []
    for version in versions:
        tag, said = f"{label}-{version.replace(' ', '.')}", f"{word}(?: version| v)? (?:v)?{version}"
        made += [
            Rule(tag, gate, keyword, f"{GIVEN} under {TERMS}{name}{said}", 1, 1.0),
            Rule(tag, gate, keyword, f"{name}{said}(?: or (?:any )?later)?", 3, 0.9),
        ]
    made += [
        Rule(label, gate, keyword, f"{GIVEN} under {TERMS}{name}{word}", 2, 0.95),
        Rule(label, "licen", keyword, f"spdx license identifier {name}", 1, 1.0),
        Rule(label, "licen", keyword, f"{LICENSE} {name}", 5, 0.7),
        Rule(label, "licen", keyword, f"{name} {LICENSE}", 4, 0.8),
    ]
    return made + [Rule(label, gate, keyword, name, 6, 0.5)] * plain


RULES = (
    *BASE,
    *(rule for family in FAMILIES for rule in _family_rules(*family)),
    *(Rule(label, _longest(keyword), keyword, pattern, 1, 0.9) for label, keyword, pattern in SENTENCES),
)


def _whole_words(pattern: str) -> str:
    return f"(?<= )(?:{pattern})(?= )"


def _gate(text: Column, rules: tuple[Rule, ...]) -> Column:
    """Whether a raw text holds the gate of any rule."""
    gates = {r.gate for r in rules}
    words = sorted(g for g in gates - {CC_BY} if not any(o in g and o != g for o in gates))
    low = F.lower(text)
    passes = [F.contains(low, F.lit(w)) for w in words]
    if CC_BY in gates:
        passes.append(F.contains(low, F.lit("cc")) & text.rlike("(?i)" + CC_BY.replace(" ", BETWEEN)))
    return reduce(or_, passes)


def word_text(text: Column) -> Column:
    """A-Z lower-cased, words with one blank between them, and one at either end."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate(text, upper, upper.lower()), BETWEEN, " ")), F.lit(" "))


def _blanks(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("bigint")


def _places(norm: Column, rule: Column) -> Column:
    """Where the rule matches: start and end in words, the end past the last one."""
    between = F.split(norm, rule["pattern"])
    matches = F.regexp_extract_all(norm, rule["pattern"], F.lit(0))
    steps = F.zip_with(between, matches, lambda b, m: F.struct(_blanks(b).alias("before"), _blanks(m).alias("inside"), m.alias("m")))
    empty = F.lit(None).cast(PLACES)
    start = F.struct(F.lit(-1).cast("bigint").alias("at"), F.coalesce(empty, F.array().cast(PLACES)).alias("found"))

    def step(state: Column, s: Column) -> Column:
        at = state["at"] + s["before"]
        here = F.struct(
            at.alias("first"), (at + s["inside"] + 1).alias("past"), rule["priority"].alias("priority"), rule["order"].alias("order"),
            rule["label"].alias("label"), rule["confidence"].alias("confidence"), rule["base"].alias("base"),
        )
        return F.struct((at + s["inside"]).alias("at"), F.concat(state["found"], F.array(here)).alias("found"))

    return F.aggregate(F.filter(steps, lambda s: s["m"].isNotNull()), start, step, lambda state: state["found"])


PLACES = "array<struct<first:bigint,past:bigint,priority:int,order:int,label:string,confidence:double,base:boolean>>"


def _kept(found: Column) -> Column:
    """Detections by priority, then length, then place, then rule: each is kept that overlaps none kept before it. In order of their
    places."""
    order = F.transform(found, lambda d: F.struct(
        d["priority"].alias("priority"), (d["first"] - d["past"]).alias("length"), d["first"].alias("first"), d["order"].alias("order"), d.alias("d")))

    def step(kept: Column, s: Column) -> Column:
        d = s["d"]
        overlaps = F.exists(kept, lambda k: (d["first"] < k["past"]) & (k["first"] < d["past"]))
        return F.when(overlaps, kept).otherwise(F.concat(kept, F.array(d)))

    return F.array_sort(F.aggregate(F.array_sort(order), F.array().cast(PLACES), step))


def scan_licenses(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, n_words, base (places of base rules), found (detections left, by start), both
    arrays of first and past word, priority, order, label, confidence and base.

    Null and empty texts have no words and empty arrays. Repeated rows give repeated results. Other columns are not read.
    """
    table = F.array(*[
        F.struct(
            F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"), F.lit(_whole_words(r.pattern)).alias("pattern"),
            F.lit(r.priority).alias("priority"), F.lit(i).alias("order"), F.lit(r.confidence).alias("confidence"),
            F.lit(r.base).alias("base"),
        )
        for i, r in enumerate(rules)
    ])
    raw = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.regexp_count(raw, F.lit(WORD)).cast("bigint").alias("n_words"),
        F.when(_gate(raw, rules), word_text(raw)).alias("norm"),
    )
    asked = F.filter(table, lambda r: F.contains(F.col("norm"), r["keyword"]))
    all_found = F.flatten(F.transform(asked, lambda r: _places(F.col("norm"), r)))
    nothing = F.array().cast(PLACES)
    rows = rows.withColumn("all", F.when(F.col("norm").isNotNull(), all_found).otherwise(nothing))
    return rows.select(
        "doc_id", "n_words", F.filter("all", lambda d: d["base"]).alias("base"), _kept(F.col("all")).alias("found")
    )


def license_labels(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Labels are distinct, sorted and joined by commas, "" if there are none. The score is the largest confidence of a detection
    that stays, 0 without any.
    """
    found = scan_licenses(docs, rules, key, text)
    firsts = F.transform("base", lambda d: d["first"])
    named = lambda c: F.transform(c, lambda d: d["label"])
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    sure = F.array_max(F.transform(F.concat("base", "found"), lambda d: d["confidence"]))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(firsts).alias("first_word"), F.array_max(firsts).alias("last_word"),
        joined(named("base")).alias("base_labels"), joined(F.concat(named("base"), named("found"))).alias("labels"),
        F.coalesce(sure, F.lit(0.0)).alias("score"),
    )
