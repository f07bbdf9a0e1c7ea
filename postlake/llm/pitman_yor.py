"""Scores of texts by a hierarchical Pitman-Yor language model.

Each context, the word before, is a restaurant; all share one parent, the restaurant of words without
context, whose base is uniform over the vocabulary and one unknown word. A sweep empties the tables of a word in a
restaurant and seats its customers again one after the other by the Chinese restaurant rule, given the parent's current
probability of the word; every table is a customer of the parent, whose tables are seated in the same way. What couples the words,
the number of tables of each restaurant, is held at its value of the round before (a Gibbs sampler over blocks of words). After
the burn-in the predictive probabilities of the rounds are averaged. Customers are seated singly up to 32; beyond, in steps of
a sixteenth of those seated, with a binomial draw for the tables opened in a step. Discounts come from counts of counts.

How it runs: one scan turns the documents into postings (word, context, document), dealt to parts, those of a bucket together, and a
part's training counts and postings become one row of a bucketed table; postings of learnt pairs name neither word nor context. Words that are frequent in a sample are hot: they have small codes, their pairs
are dealt by context, and what the parent knows of them, one number for each of at most `HOT_WORDS`, is summed by the driver. All other
words are dealt by word, so their part knows the parent's state. A pair is in one part only. A round reads the counts, meets the
totals of its contexts, a row for each part, and sends the tables it seated to the homes of the contexts, which add them up and
return the sums in the order of each part's contexts. A last pass seats the kept rounds again from the same seeds and adds up the
scores of documents. The sample decides only where work is done and what is updated within a sweep: a hot word's probability in
the parent is that of the round before.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.session import co_located, run_folder, setting

from .words import GOLDEN, WordIds, blank_words, fold, mix, texts, written

CONTEXTS = 4096  # of counts whose number of contexts is not given
ROUNDS = 3
BURN_IN = 1
SWEEPS = 2
STRENGTH = 1.0
CHUNK_TOKENS = 750_000
CHUNK_DOCS = 60_000  # document numbers within a chunk fit 16 bits
PART_TOKENS = 300_000
BYTES_A_WORD = 6
PARTS_A_BUCKET = 8
BATCH_ROWS = 500  # texts and postings are long: batches of Spark's own size would fill the memory of tasks
BATCH_BYTES = 4 << 20
PARTS_A_HOME = 16
HOT_WORDS = 16384
HOT_SHARE = 1000  # a hot word has more than this part of a part's tokens
HOT_SAMPLE = 5000
END, START = np.uint64(2**64 - 1), np.uint64(2**64 - 2)
TOLD = 1_000_000  # documents whose sums a task holds before it passes them on
PAIRS = "pairs binary, homes binary"
POSTINGS = "chunks binary, spots binary, others binary"
GATHERED = "part bigint, base bigint, ids array<bigint>, held array<boolean>, tokens array<bigint>, blob binary"
MERGED = f"part bigint, base bigint, ids array<bigint>, held array<boolean>, tokens array<bigint>, {PAIRS}, keys binary, {POSTINGS}"
SENT = "home bigint, part bigint, keys binary, blob binary, at bigint, value double"
SETTLED = "home bigint, part bigint, blob binary, places binary, customers binary"


@dataclass
class Layout:
    parts: int  # of words that are not hot
    salts: int  # parts of hot words
    homes: int
    hot: np.ndarray  # sorted ids
    codes: np.ndarray  # of these, from 1, the most frequent first
    heavy: int  # so many have more than half a part's share
    lead: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # of each part the first part in its bucket

    def coded(self, words: np.ndarray) -> np.ndarray:
        """Hot words by their code, others by their id."""
        if not len(self.hot):
            return words
        at = np.minimum(np.searchsorted(self.hot, words), len(self.hot) - 1)
        return np.where(self.hot[at] == words, self.codes[at], words)

    def part_of(self, words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """Hot words lie by context, in heavy contexts by pair, others by word."""
        heavy = (contexts <= np.uint64(self.heavy)) | (contexts == START)
        key = mix(np.where(heavy, contexts + words * GOLDEN, contexts))
        hot = words <= np.uint64(len(self.hot))
        return np.where(hot, np.uint64(self.parts) + key % np.uint64(self.salts), words % np.uint64(self.parts)).astype(np.int64)

    def home_of(self, contexts: np.ndarray) -> np.ndarray:
        return ((mix(contexts) >> np.uint64(20)) % np.uint64(self.homes)).astype(np.int64)


def _nothing() -> np.ndarray:
    return np.zeros(0)


@dataclass
class Totals:
    """What words share: tables and customers by context (of one part), tables and customers of the root, in all and of hot words."""

    tables: np.ndarray
    customers: np.ndarray
    root_customers: float = 0.0
    root_tables: float = 0.0
    hot_root: np.ndarray = field(default_factory=_nothing)  # by code
    hot_tables: np.ndarray = field(default_factory=_nothing)


@dataclass
class Model:
    tokens: int
    vocabulary: int
    discount: float
    root_discount: float
    rounds: list[Totals] = field(default_factory=list)
    hot_counts: np.ndarray = field(default_factory=_nothing)


# --- postings


def squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueezed(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)


def columns(*arrays: np.ndarray) -> bytes:
    """Arrays in one blob, whole numbers in as few bytes as the largest needs, bytes of one rank side by side."""
    narrow = [a if a.dtype.kind == "f" else a.astype(np.min_scalar_type(a.max(initial=0))) for a in arrays]
    head = np.array([[len(a), a.itemsize] for a in narrow], np.uint32)
    return squeeze(b"".join([head.tobytes(), *(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in narrow)]))


def columns_of(blob: bytes, n: int) -> list[np.ndarray]:
    """The `n` arrays of a blob; eight bytes are whole numbers unless viewed as something else."""
    blob = unsqueezed(blob)
    at, found = 8 * n, []
    for size, width in np.frombuffer(blob, np.uint32, 2 * n).reshape(n, 2).tolist():
        raw = np.frombuffer(blob, np.uint8, size * width, at).reshape(width, size)
        found.append(np.ascontiguousarray(raw.T).view(f"u{width}").reshape(size))
        at += size * width
    return found


def steps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending.astype(np.uint64), prepend=np.uint64(0))


def summed_steps(made: np.ndarray) -> np.ndarray:
    return np.cumsum(made.astype(np.uint64), dtype=np.uint64)


def pack(
    base: int, trained: np.ndarray, words: np.ndarray, sizes: np.ndarray, contexts: np.ndarray, docs: np.ndarray, parts=((), ())
) -> bytes:
    """Postings: distinct words in order, tokens of each, of each token the context and the document. Documents to learn from come
    first. Those of several parts stand one after the other; `parts` are these and the number of distinct words of each."""
    n_trained = int(np.count_nonzero(trained))
    if not np.all(trained[:n_trained]):
        raise ValueError("documents to learn from must come first")
    keys, at = np.unique(contexts, return_inverse=True)
    of_parts = (np.array(p, np.int64) for p in parts)
    return columns(np.array([base, len(trained), n_trained], np.uint64), steps(words), sizes.astype(np.uint32), steps(keys), at, docs, *of_parts)


@dataclass
class Postings:
    base: int
    n_docs: int
    n_trained: int
    words: np.ndarray  # distinct
    sizes: np.ndarray  # tokens of each
    keys: np.ndarray  # distinct contexts
    at: np.ndarray  # of each token its context among these
    docs: np.ndarray  # of each token

    def split(self, parts: list[int], n_words: list[int]) -> Iterator[tuple[int, Postings]]:
        word = token = 0
        for part, n in zip(parts, n_words):
            sizes = self.sizes[word : word + n]
            until = token + int(sizes.sum())
            at = self.at[token:until]
            used = np.bincount(at, minlength=len(self.keys)) > 0
            narrow = (np.cumsum(used) - 1).astype(self.at.dtype)[at]
            yield part, replace(self, words=self.words[word : word + n], sizes=sizes, keys=self.keys[used], at=narrow, docs=self.docs[token:until])
            word, token = word + n, until


def unpack(blob: bytes) -> tuple[Postings, list[int], list[int]]:
    head, words, sizes, keys, at, docs, *parts = columns_of(blob, 8)
    return Postings(*head.tolist(), summed_steps(words), sizes.astype(np.int64), summed_steps(keys), at, docs), *(p.tolist() for p in parts)


def _chunk(base: int, ids: list, held: list[bool], each: list[np.ndarray], layout: Layout) -> Iterator[pa.RecordBatch]:
    order = np.argsort(held, kind="stable").tolist()  # those to learn from come first
    ids, held, each = ([x[i] for i in order] for x in (ids, held, each))
    sizes = np.array([len(e) for e in each])
    words = layout.coded(np.concatenate(each))
    docs = np.repeat(np.arange(len(each)), sizes)
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[np.cumsum(sizes) - sizes] = START
    part = layout.part_of(words, before)
    lead = layout.lead[part]
    order = np.lexsort((before, words, part, lead))
    lead, part, words, contexts, docs = lead[order], part[order], words[order], before[order], docs[order]
    trained = ~np.array(held, bool)
    # Parts of one bucket travel together: so many more parts would make as many more and smaller blobs.
    names, starts = np.unique(lead, return_index=True)
    ends = np.append(starts[1:], len(part))
    blobs = []
    for a, b in zip(starts, ends):
        new = np.flatnonzero(np.append(True, (words[a + 1 : b] != words[a : b - 1]) | (part[a + 1 : b] != part[a : b - 1])))
        of_words = np.unique(part[a:b][new], return_counts=True)
        blobs.append(pack(base, trained, words[a:b][new], np.diff(np.append(new, b - a)), contexts[a:b], docs[a:b], of_words))
    n = len(blobs)
    # The documents themselves travel as one more row, under a negative part.
    made = pa.record_batch({
        "part": pa.array([-1 - base % layout.parts, *names.tolist()], pa.int64()), "base": pa.array([base] * (n + 1), pa.int64()),
        "ids": pa.array([ids] + [None] * n, pa.list_(pa.int64())), "held": pa.array([held] + [None] * n, pa.list_(pa.bool_())),
        "tokens": pa.array([sizes.tolist()] + [None] * n, pa.list_(pa.int64())), "blob": pa.array([None, *blobs], pa.binary()),
    })
    for at in range(0, n + 1, BATCH_ROWS):
        yield made.slice(at, BATCH_ROWS)


def _gather(layout: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordIds()
        base, ids, held, each, size = 0, [], [], [], 0
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "held_out")), texts(batch.column("text")))
            for row, doc_id, out, text in rows:
                if each and (size >= CHUNK_TOKENS or len(each) >= CHUNK_DOCS):
                    yield from _chunk(base, ids, held, each, layout)
                    ids, held, each, size = [], [], [], 0
                if not each:
                    base = row
                ids.append(doc_id)
                held.append(out)
                each.append(np.append(known.of(blank_words(text)), END))
                size += len(each[-1])
        if each:
            yield from _chunk(base, ids, held, each, layout)

    return run


@dataclass
class Part:
    """Postings of a part. Tokens of pairs that were learnt stand in the order of the pairs, others in a blob of their own; documents
    are numbered through the chunks."""

    pairs: tuple[np.ndarray, ...]  # learnt: distinct words, pairs of each, context and count of each pair, contexts of each home
    keys: np.ndarray  # the contexts of all postings, by home; others refer to their place here
    chunks: tuple[np.ndarray, ...]  # base and documents of each
    spots: tuple[np.ndarray, ...]  # tokens of each learnt pair, document of each
    others: bytes


def gathered(found: list[Postings], layout: Layout) -> Part:
    found = sorted(found, key=lambda f: f.base)
    bases, n_docs = np.array([f.base for f in found], np.int64), np.array([f.n_docs for f in found], np.int64)
    first = np.cumsum(n_docs) - n_docs
    keys = np.unique(np.concatenate([f.keys for f in found]))
    home = layout.home_of(keys)
    by_home = np.argsort(home, kind="stable")
    place = np.empty(len(keys), np.int64)
    place[by_home] = np.arange(len(keys))
    vocabulary = np.unique(np.concatenate([f.words for f in found]))
    code, docs, kept = [], [], []
    for start, f in zip(first.tolist(), found):
        code.append(np.repeat(np.searchsorted(vocabulary, f.words) * len(keys), f.sizes) + place[np.searchsorted(keys, f.keys)][f.at])
        docs.append(np.add(start, f.docs, dtype=np.int64))
        kept.append(f.docs < f.n_trained)
    code, docs, kept = (np.concatenate(x) for x in (code, docs, kept))
    order = np.argsort(code, kind="stable")
    code, docs, kept = code[order], docs[order], kept[order]
    at = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    sizes = np.diff(np.append(at, len(code)))
    counts = np.add.reduceat(kept, at, dtype=np.int64)
    word, context = np.divmod(code[at], len(keys))
    learnt = counts > 0
    tokens = np.repeat(learnt, sizes)
    distinct, pairs = np.unique(word[learnt], return_counts=True)
    rest, of_rest = np.unique(np.repeat(word[~learnt], sizes[~learnt]), return_counts=True)
    return Part(
        (vocabulary[distinct], pairs, context[learnt], counts[learnt], np.bincount(home, minlength=layout.homes)), keys[by_home], (bases, n_docs),
        (sizes[learnt], docs[tokens]), pack(0, np.zeros(0, bool), vocabulary[rest], of_rest, np.repeat(context[~learnt], sizes[~learnt]), docs[~tokens]),
    )


def _merge(layout: Layout):
    """Rows come sorted by the first part of their bucket: one row for each part, rows of documents as they are."""

    def row(part: int, base=None, ids=None, held=None, tokens=None, blobs=(None,) * 6) -> pa.RecordBatch:
        made = [[part], [base], [ids], [held], [tokens], *[[b] for b in blobs]]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), *[pa.binary()] * 6]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(made, kinds)], names=[x.split()[0] for x in MERGED.split(", ")])

    def done(parts: dict[int, list[Postings]]) -> Iterator[pa.RecordBatch]:
        for part in sorted(parts):
            found = gathered(parts.pop(part), layout)
            words, *pairs, homes = found.pairs
            made = columns(steps(words), *pairs), columns(homes), columns(steps(found.keys)), columns(*found.chunks), columns(*found.spots), found.others
            yield row(part, blobs=made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, parts = None, {}
        for batch in batches:
            for i, name in enumerate(batch.column("part").to_pylist()):
                if name < 0:
                    yield row(name, *(batch.column(c)[i].as_py() for c in ("base", "ids", "held", "tokens")))
                    continue
                if name != lead:
                    yield from done(parts)
                lead = name
                postings, *each = unpack(batch.column("blob")[i].as_py())
                for part, own in postings.split(*each):
                    parts.setdefault(part, []).append(own)
        yield from done(parts)

    return run


# --- the sampler


def seat(customers: np.ndarray, open_weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after the customers of each row sat down in turn: the k-th opens one with odds open_weight : k - discount * tables."""
    tables = np.minimum(customers, 1).astype(np.int64)
    at = np.flatnonzero(customers > 1)
    left, weight, made = customers[at], open_weight[at], np.ones(len(at), np.int64)
    seated = 1
    while len(at):
        step = max(1, seated >> 4)
        odds = weight / (seated - discount * made + weight)
        made = made + (rng.random(len(at)) < odds if step == 1 else rng.binomial(np.minimum(step, left - seated), odds))
        seated += step
        rest = left > seated
        if not rest.all():
            tables[at[~rest]] = made[~rest]
            at, left, weight, made = at[rest], left[rest], weight[rest], made[rest]
    return tables


@dataclass
class Seating:
    tables: np.ndarray  # of each pair
    root: np.ndarray  # customers of each word in the root
    root_tables: np.ndarray


@dataclass
class Counts:
    words: np.ndarray
    starts: np.ndarray
    owner: np.ndarray
    contexts: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Counts:
        words, *others = columns_of(row["pairs"], 4)
        size, contexts, counts = (x.astype(np.int64) for x in others)
        return cls(summed_steps(words), np.cumsum(size) - size, np.repeat(np.arange(len(size)), size), contexts, counts)

    def by_word(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts) if len(self.starts) else np.zeros(0, values.dtype)


def root_probability(root: np.ndarray, tables: np.ndarray, totals: Totals, model: Model) -> np.ndarray:
    spare = (STRENGTH + model.root_discount * totals.root_tables) / (model.vocabulary + 1)
    return (root - model.root_discount * tables + spare) / (STRENGTH + totals.root_customers)


def root_chances(words: np.ndarray, root: np.ndarray, tables: np.ndarray, totals: Totals, model: Model) -> np.ndarray:
    """Of words of a part: hot ones by their sums over all parts."""
    hot = words <= np.uint64(len(totals.hot_root))
    if hot.any():
        code = words[hot].astype(np.int64) - 1
        root, tables = root.astype(np.float64), tables.astype(np.float64)
        root[hot], tables[hot] = totals.hot_root[code], totals.hot_tables[code]
    return root_probability(root, tables, totals, model)


def sample(counts: Counts, model: Model, turn: int, part: int, seed: int) -> Seating:
    """Round `turn` for the words of a part, given the totals of the round before."""
    totals = model.rounds[turn - 1]
    rng = np.random.default_rng([seed, turn, part])
    root = counts.by_word(np.ones(len(counts.counts), np.int64))
    root_tables = np.ones(len(root), np.int64)
    weight = STRENGTH + model.discount * totals.tables[counts.contexts]
    spare = (STRENGTH + model.root_discount * totals.root_tables) / (model.vocabulary + 1)
    tables = np.ones(len(counts.counts), np.int64)
    for _ in range(SWEEPS):
        chance = root_chances(counts.words, root, root_tables, totals, model)
        tables = seat(counts.counts, weight * chance[counts.owner], model.discount, rng)
        root = counts.by_word(tables)
        root_tables = seat(root, np.full(len(root), spare), model.root_discount, rng)
    return Seating(tables, root, root_tables)


def _first_sums(counts: Counts, contexts: int = CONTEXTS, hot: int = 0) -> np.ndarray:
    """Every pair one table: tables and customers by context, and counts of counts of pairs and, but for hot words, of the root."""
    root = counts.by_word(np.ones(len(counts.counts), np.int64))[counts.words > np.uint64(hot)]
    some = [len(counts.counts), len(root), *((counts.counts == k).sum() for k in (1, 2)), *((root == k).sum() for k in (1, 2))]
    by_context = [np.bincount(counts.contexts, w, contexts) for w in (None, counts.counts)]
    return np.concatenate([*by_context, np.array(some, np.float64)])


def _round_sums(counts: Counts, made: Seating, contexts: int = CONTEXTS, hot: int = 0) -> np.ndarray:
    cold = counts.words > np.uint64(hot)
    return np.concatenate([np.bincount(counts.contexts, made.tables, contexts), [made.root[cold].sum(), made.root_tables[cold].sum()]])


def _hot_sums(counts: Counts, values: np.ndarray, hot: int) -> np.ndarray:
    """Sums of values of pairs by hot word."""
    codes = counts.words[counts.owner].astype(np.uint64)
    is_hot = codes <= np.uint64(hot)
    return np.bincount(codes[is_hot].astype(np.int64) - 1, values[is_hot], hot) if hot else np.zeros(0)


def _sent(rows: DataFrame, make, size: int) -> DataFrame:
    """Of each part: its contexts and what it has for them, for each home, written; and sums over all parts of a vector of fixed
    size, of which each task sends its own, under home -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)

        def batch_of(home, part, keys, blob, at, value) -> pa.RecordBatch:
            kinds = pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.float64()
            made = [pa.array(v, k) for v, k in zip((home, part, keys, blob, at, value), kinds)]
            return pa.RecordBatch.from_arrays(made, names=[x.split()[0] for x in SENT.split(", ")])

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                by_context, sums = make(row)
                total += sums
                ends = np.cumsum(columns_of(row["homes"], 1)[0], dtype=np.int64)
                some = [(h, a, b) for h, (a, b) in enumerate(zip(np.append(0, ends[:-1]).tolist(), ends.tolist())) if b > a]
                keys = summed_steps(columns_of(row["keys"], 1)[0]) if row.get("keys") else None
                n = len(some)
                yield batch_of(
                    [h for h, _, _ in some], [row["part"]] * n, [None if keys is None else columns(steps(keys[a:b])) for _, a, b in some],
                    [squeeze(by_context[:, a:b].astype(np.int64).tobytes()) for _, a, b in some], [None] * n, [None] * n,
                )
        at = np.flatnonzero(total)
        n = len(at)
        yield batch_of([-1] * n, [None] * n, [None] * n, [None] * n, at, total[at])

    return written(rows.mapInArrow(run, SENT), "sent")


def _summed(sent: DataFrame, size: int) -> np.ndarray:
    found = np.zeros(size)
    for row in sent.where("home = -1").groupBy("at").agg(F.sum("value").alias("value")).collect():
        found[row["at"]] = row["value"]
    return found


def _settle(group: pa.Table) -> pa.Table:
    """What a home returns to each part: customers and tables of the part's contexts, over all parts. The first time it also makes a
    row of its own, the place of each of these contexts and their customers."""
    own = [r for r in group.select(["home", "places", "customers"]).to_pylist() if r["places"] is not None]
    rows = sorted((r for r in group.select(["part", "keys", "blob"]).to_pylist() if r["part"] is not None), key=lambda r: r["part"])
    home = group["home"][0].as_py()
    made = {"home": [], "part": [], "blob": [], "places": [], "customers": []}

    def add(**row) -> None:
        for name, values in made.items():
            values.append(home if name == "home" else row.get(name))

    sent = [np.frombuffer(unsqueezed(r["blob"]), np.int64) for r in rows]
    if own:
        place = np.frombuffer(unsqueezed(own[0]["places"]), np.uint32)
        customers = np.frombuffer(unsqueezed(own[0]["customers"]), np.int64)
        tables = np.bincount(place, np.concatenate(sent), len(customers)).astype(np.int64)
        sizes = [len(x) for x in sent]
    else:
        keys = [summed_steps(columns_of(r["keys"], 1)[0]) for r in rows]
        sizes = [len(k) for k in keys]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        both = [np.bincount(place, np.concatenate([x.reshape(2, -1)[k] for x in sent]), len(distinct)).astype(np.int64) for k in (0, 1)]
        tables, customers = both
        add(places=squeeze(place.astype(np.uint32).tobytes()), customers=squeeze(customers.tobytes()))
    at = 0
    for r, size in zip(rows, sizes):
        here = place[at : at + size]
        at += size
        add(part=r["part"], blob=squeeze(np.concatenate([customers[here], tables[here]]).tobytes()))
    kinds = pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()
    return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(made.items(), kinds)})


def _settled(sent: DataFrame, homes: DataFrame | None) -> DataFrame:
    none = lambda kind: F.lit(None).cast(kind)
    rows = sent.where("home >= 0").select("home", "part", "keys", "blob", none("binary").alias("places"), none("binary").alias("customers"))
    if homes is not None:
        own = homes.where("part IS NULL")
        rows = rows.unionAll(own.select("home", none("bigint").alias("part"), none("binary").alias("keys"), none("binary").alias("blob"), "places", "customers"))
    return written(rows.groupBy("home").applyInArrow(_settle, SETTLED), "settled")


def _meet(table: DataFrame, settled: dict[int, DataFrame], *more: str) -> DataFrame:
    """Rows of parts with `met_k`, what the homes returned after round k. The table stays in its buckets."""
    rows = table.where("part >= 0").select("part", *[c.split()[0] for c in PAIRS.split(", ")], *more)
    for turn, found in settled.items():
        blobs = F.transform(F.sort_array(F.collect_list(F.struct("home", "blob"))), lambda x: x["blob"])
        rows = rows.join(found.where("part IS NOT NULL").groupBy("part").agg(blobs.alias(f"met_{turn}")), "part")
    return rows


def of_part(model: Model, row: dict) -> Model:
    """The model with the totals of the contexts of a part."""
    rounds = list(model.rounds)
    for turn, totals in enumerate(rounds):
        if f"met_{turn}" in row:
            found = [np.frombuffer(unsqueezed(b), np.int64).reshape(2, -1) for b in row[f"met_{turn}"]]
            customers, tables = np.concatenate(found, axis=1)
            rounds[turn] = replace(totals, tables=tables, customers=customers)
    return replace(model, rounds=rounds)


def _discount(ones: float, twos: float) -> float:
    return float(np.clip(ones / (ones + 2 * twos), 0.05, 0.95)) if ones else 0.5


def train(table: DataFrame, rounds: int, seed: int, hot: int = 0) -> tuple[Model, dict[int, DataFrame]]:
    """The totals of all rounds over a table of parts (`MERGED`): those of the root, and for each round from the burn-in the table
    of those by context."""

    def first(row: dict):
        counts = Counts.of(row)
        n = int(columns_of(row["homes"], 1)[0].sum(dtype=np.int64))
        found = _first_sums(counts, n, hot)
        pairs, tokens = (_hot_sums(counts, x, hot) for x in (np.ones(len(counts.counts)), counts.counts))
        return found[: 2 * n].reshape(2, n), np.concatenate([found[2 * n :], [counts.counts.sum()], pairs, tokens])

    sent = _sent(_meet(table, {}, "keys"), first, 7 + 2 * hot)
    sums = _summed(sent, 7 + 2 * hot)
    n_pairs, n_words, ones, twos, root_ones, root_twos, tokens = sums[:7]
    hot_pairs, hot_counts = sums[7 : 7 + hot], sums[7 + hot :]
    words = n_words + (hot_pairs > 0).sum()
    root_ones, root_twos = (n + (hot_pairs == k).sum() for n, k in ((root_ones, 1), (root_twos, 2)))
    model = Model(int(tokens), int(words), _discount(ones, twos), _discount(root_ones, root_twos), hot_counts=hot_counts)
    model.rounds.append(Totals(_nothing(), _nothing(), n_pairs, words, hot_pairs, np.minimum(hot_pairs, 1)))
    homes = settled = _settled(sent, None)
    kept = {}
    for turn in range(1, rounds + 1):

        def seated(row: dict):
            counts, own = Counts.of(row), of_part(model, row)
            made = sample(counts, own, turn, row["part"], seed)
            n = len(own.rounds[turn - 1].tables)
            found = _round_sums(counts, made, n, hot)
            return found[:n].reshape(1, n), np.concatenate([found[n:], _hot_sums(counts, made.tables, hot)])

        sent = _sent(_meet(table, {turn - 1: settled}), seated, 2 + hot)
        customers, tables, *hot_root = _summed(sent, 2 + hot)
        hot_root = np.array(hot_root)
        spare = (STRENGTH + model.root_discount * model.rounds[-1].root_tables) / (model.vocabulary + 1)
        hot_tables = seat(hot_root.astype(np.int64), np.full(hot, spare), model.root_discount, np.random.default_rng([seed, turn]))
        model.rounds.append(Totals(_nothing(), _nothing(), customers + hot_root.sum(), tables + hot_tables.sum(), hot_root, hot_tables))
        settled = _settled(sent, homes)
        if turn >= BURN_IN:
            kept[turn] = settled
    return model, kept


# --- scores


@dataclass
class Predictive:
    """What tokens of some words need: counts, and averages over the kept rounds."""

    words: np.ndarray
    counts: np.ndarray  # of words
    codes: np.ndarray  # word row and context of each pair, sorted
    contexts: int
    own: np.ndarray  # mean share of the pair's own customers
    chances: list[np.ndarray]  # root probability of each word, by round


def predictive(counts: Counts, model: Model, part: int, seed: int) -> Predictive:
    own, chances = np.zeros(len(counts.counts)), []
    kept = range(BURN_IN + 1, len(model.rounds))
    # Hot words are known wherever they were met.
    hot = (np.flatnonzero(model.hot_counts) + 1).astype(np.uint64)
    words = np.union1d(counts.words, hot)
    at = np.searchsorted(words, counts.words)

    def spread(values: np.ndarray) -> np.ndarray:
        made = np.zeros(len(words))
        made[at] = values
        return made

    for turn in kept:
        made, totals = sample(counts, model, turn, part, seed), model.rounds[turn]
        own += (counts.counts - model.discount * made.tables) / (STRENGTH + totals.customers[counts.contexts]) / len(kept)
        chances.append(root_chances(words, spread(made.root), spread(made.root_tables), totals, model))
    known = spread(counts.by_word(counts.counts))
    is_hot = words <= np.uint64(len(model.hot_counts))
    known[is_hot] = model.hot_counts[words[is_hot].astype(np.int64) - 1]
    n = len(model.rounds[-1].tables)
    return Predictive(words, known, at[counts.owner] * n + counts.contexts, n, own, chances)


class Scores:
    """Sums of documents by chunk, passed on when there are many: base score, score, known tokens."""

    def __init__(self):
        self.sums, self.held = {}, 0

    def add(self, blob: bytes, known: Predictive, model: Model, chunks: list[np.ndarray] | None = None) -> None:
        """Any tokens: of the chunk of the blob, or numbered through `chunks`."""
        postings, *_ = unpack(blob)
        words, sizes, contexts = postings.words, postings.sizes, postings.keys.astype(np.int64)[postings.at]
        at = np.searchsorted(known.words, words)
        at[at == len(known.words)] = 0
        met = known.words[at] == words if len(known.words) else np.zeros(len(words), bool)
        count = np.where(met, known.counts[at], 0) if len(known.words) else np.zeros(len(words))
        row, seen = np.repeat(np.where(met, at, 0), sizes), np.repeat(met, sizes)
        chance = np.zeros(len(row))
        kept = range(BURN_IN + 1, len(model.rounds))
        for totals, chances in zip((model.rounds[k] for k in kept), known.chances):
            unseen = root_probability(np.zeros(1), np.zeros(1), totals, model)[0]
            root = np.where(seen, chances[row], unseen) if len(chances) else np.full(len(row), unseen)
            chance += up(totals, model)[contexts] * root / len(kept)
        if len(known.codes):
            code = row * known.contexts + contexts
            pair = np.minimum(np.searchsorted(known.codes, code), len(known.codes) - 1)
            chance += np.where(seen & (known.codes[pair] == code), known.own[pair], 0)
        chunks = chunks or [np.array([postings.base]), np.array([postings.n_docs])]
        self.sum_up(chunks, postings.docs, np.repeat(basic(count, model), sizes), np.log10(chance), seen)

    def add_learnt(self, spots: bytes, known: Predictive, model: Model, chunks: list[np.ndarray]) -> None:
        """The tokens of the learnt pairs, in the order of these."""
        sizes, docs = columns_of(spots, 2)
        row, contexts = np.divmod(known.codes, known.contexts)
        chance = known.own.copy()
        for totals, chances in zip(model.rounds[BURN_IN + 1 :], known.chances):
            chance += up(totals, model)[contexts] * chances[row] / len(known.chances)
        pair = np.repeat(np.arange(len(sizes)), sizes)
        self.sum_up(chunks, docs, basic(known.counts, model)[row][pair], np.log10(chance)[pair], np.ones(len(docs)))

    def sum_up(self, chunks: list[np.ndarray], docs: np.ndarray, *values: np.ndarray) -> None:
        bases, n_docs = (x.astype(np.int64) for x in chunks)
        ends = np.cumsum(n_docs)
        numbers, place = np.unique(docs, return_inverse=True)
        found = np.stack([np.bincount(place, v, len(numbers)) for v in values])
        cuts = np.searchsorted(numbers, np.append(0, ends))
        for base, n, end, a, b in zip(bases.tolist(), n_docs.tolist(), ends.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
            if b > a:
                if base not in self.sums:
                    self.sums[base] = np.zeros((len(values), n))
                    self.held += n
                self.sums[base][:, numbers[a:b] - (end - n)] += found[:, a:b]

    def told(self) -> pa.RecordBatch:
        """Of the documents that had tokens."""
        blobs = []
        for total in self.sums.values():
            at = np.flatnonzero(total.any(axis=0))
            blobs.append(columns(steps(at), total[2, at].astype(np.int64), total[0, at], total[1, at]))
        made = pa.record_batch({"base": pa.array(list(self.sums), pa.int64()), "blob": pa.array(blobs, pa.binary())})
        self.sums, self.held = {}, 0
        return made


def basic(counts: np.ndarray, model: Model) -> np.ndarray:
    return np.log10((counts + 0.1) / (model.tokens + 0.1 * (model.vocabulary + 1)))


def up(totals: Totals, model: Model) -> np.ndarray:
    """What each context leaves to the root."""
    return (STRENGTH + model.discount * totals.tables) / (STRENGTH + totals.customers)


def _hot_words(docs: DataFrame, n_docs: int, parts: int, text: str) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words of a sample of about `HOT_SAMPLE` documents: ids and shares of the tokens."""
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("t")) if parts > 1 else docs.select(F.col(text).alias("t")).limit(0)
    few = rows.where(F.pmod(F.xxhash64("t"), F.lit(max(1, n_docs // HOT_SAMPLE))) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = WordIds()
            each = [np.append(ids.of(blank_words(value)), END) for value in texts(batch.column("t"))]
            if each:
                distinct, counts = np.unique(np.concatenate(each), return_counts=True)
                yield pa.record_batch({"word": pa.array(distinct.view(np.int64), pa.int64()), "n": pa.array(counts, pa.int64())})

    counted = few.mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counted = written(counted, "sample-words")
    total = counted.agg(F.sum("n")).first()[0] or 0
    often = counted.where(F.col("n") > total / (HOT_SHARE * parts)).orderBy(F.desc("n"), "word").limit(HOT_WORDS).collect()
    return np.array([r["word"] for r in often], np.int64).view(np.uint64), np.array([r["n"] / total for r in often])


def _layout(docs: DataFrame, size: int, n_docs: int, text: str) -> Layout:
    parts = max(1, -(-size // (BYTES_A_WORD * PART_TOKENS)))
    words, shares = _hot_words(docs, n_docs, parts, text)
    order = np.argsort(words)
    salts = max(1, round(parts * float(shares.sum())))
    return Layout(
        max(1, parts - salts), salts, -(-parts // PARTS_A_HOME), words[order], (order + 1).astype(np.uint64),
        int((shares > 1 / (2 * parts)).sum()),
    )


def _leads(spark: SparkSession, parts: int, buckets: int) -> np.ndarray:
    """Of each part the first one that a table bucketed by part has in the same bucket."""
    of = np.array([r[0] for r in spark.range(parts).orderBy("id").select(F.pmod(F.hash("id"), F.lit(buckets))).collect()], np.int64)
    _, first, place = np.unique(of, return_index=True, return_inverse=True)
    return first[place]


def _in_buckets(rows: DataFrame, buckets: int) -> str:
    """The name of a table of the rows, bucketed by part, in the shared folder."""
    name = f"postings_{uuid.uuid4().hex}"
    rows.write.format("parquet").bucketBy(buckets, "part").option("path", run_folder(rows.sparkSession, "postings")).saveAsTable(name)
    return name


def score_documents(docs: DataFrame, folds: int = 10, held_out: int = 0, key: str = "doc_id", text: str = "text", seed: int = 2, rounds: int = ROUNDS) -> DataFrame:
    """One row for each row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are lower-cased (A-Z) words `[^\\x20\\x09-\\x0D]+` and one end; null texts count as empty and are one end token. The
    model learns from rows whose fold (crc32 of the id as text; of "" for a null id) is not `held_out`. Scores are sums of log10
    over tokens: `base_score` of add-0.1 unigrams, `score` of the model. Repeated rows each train and are scored. An empty
    table gives no rows; if no row trains, every token is unknown. Other columns of `docs` are not read. `docs` is to come from
    files, whose rows a task that is run again meets in the same order.
    """
    spark = docs.sparkSession
    with setting(spark, execution__arrow__maxRecordsPerBatch=str(BATCH_ROWS), execution__arrow__maxBytesPerBatch=str(BATCH_BYTES)):
        return _scored(docs, folds, held_out, key, text, seed, rounds)


def _scored(docs: DataFrame, folds: int, held_out: int, key: str, text: str, seed: int, rounds: int) -> DataFrame:
    spark = docs.sparkSession
    size, n_docs = docs.agg(F.sum(F.octet_length(text)), F.count(F.lit(1))).first()
    layout = _layout(docs, size or 0, n_docs, text)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("bigint").alias("doc_id"),
        (fold(F.col(key), folds) == held_out).alias("held_out"), F.col(text).alias("text"),
    )
    buckets = -(-(layout.parts + layout.salts) // PARTS_A_BUCKET)
    layout.lead = _leads(spark, layout.parts + layout.salts, buckets)
    dealt = rows.mapInArrow(_gather(layout), GATHERED).repartition(buckets, "part").sortWithinPartitions("part")
    name = _in_buckets(dealt.mapInArrow(_merge(layout), MERGED), buckets)
    try:
        with co_located(spark, buckets):
            return _scored_parts(spark.table(name), len(layout.hot), rounds, seed)
    finally:
        spark.sql(f"DROP TABLE {name}")


def _scored_parts(table: DataFrame, hot: int, rounds: int, seed: int) -> DataFrame:
    model, kept = train(table, rounds, seed, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores()
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                own = of_part(model, row)
                known = predictive(Counts.of(row), own, row["part"], seed)
                chunks = columns_of(row["chunks"], 2)
                scores.add_learnt(row["spots"], known, own, chunks)
                scores.add(row["others"], known, own, chunks)
                if scores.held > TOLD:
                    yield scores.told()
        yield scores.told()

    told = _meet(table, kept, *[c.split()[0] for c in POSTINGS.split(", ")]).mapInArrow(run, "base bigint, blob binary")
    named = table.where("part < 0").select("base", "ids", "held", "tokens", F.lit(None).cast("binary").alias("blob"))
    empty = [F.lit(None).cast(k).alias(c) for c, k in (("ids", "array<bigint>"), ("held", "array<boolean>"), ("tokens", "array<bigint>"))]
    together = named.unionAll(told.select("base", *empty, "blob"))
    trained = model.tokens

    def finish(group: pa.Table) -> pa.Table:
        about = next(r for r in group.to_pylist() if r["ids"] is not None)
        total = np.zeros((3, len(about["ids"])))
        for blob in group["blob"].to_pylist():
            if blob is not None:
                at, known, *scores = columns_of(blob, 4)
                at = summed_steps(at).astype(np.int64)
                total[:, at] += np.stack([*(x.view(np.float64) for x in scores), known])
        return pa.table({
            "doc_id": pa.array(about["ids"], pa.int64()), "held_out": pa.array(about["held"], pa.bool_()),
            "n_tokens": pa.array(about["tokens"], pa.int64()), "n_known": pa.array(np.rint(total[2]).astype(np.int64), pa.int64()),
            "train_tokens": pa.array([trained] * len(about["ids"]), pa.int64()),
            "base_score": pa.array(total[0], pa.float64()), "score": pa.array(total[1], pa.float64()),
        })

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return written(together.groupBy("base").applyInArrow(finish, schema), "scores")
