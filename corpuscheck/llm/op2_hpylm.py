"""LM scoring with a hierarchical Pitman-Yor model.

Restaurants: one for each context (the previous token), whose tables are
customers of one root restaurant, whose base is uniform over the ``V`` training
words and one unknown. Every token that recurs in training has a restaurant of
its own, however many there are; histories seen once share by hash as many as
there are of them. Dishes are words, never cut. Seating is sampled by Gibbs (customers leave and choose a table
again); a dish of more than ``SEATED`` customers draws its number of tables by
the same rule in growing steps. Predictive probabilities are averaged over the
samples kept:

    P(w | u) = mean (c_uw - d t_uw) / (theta + c_u) + mean (theta + d t_u) / (theta + c_u) * P(w)

How it is spread: the root's customers of a word are the tables of that word
in all contexts, so a partition owns a range of words with all their contexts,
and sampling needs only the context's expected number of tables and the word's
own root share. Words so frequent that one would unbalance the partitions are
spread by context; their root totals and the most frequent pairs are bounded tables. The contexts'
totals are a table that grows with the corpus and is sent to all tasks. Randomness is a hash of (word, context,
sweep), so a restarted task and the scoring pass draw the same seating.

Passes: (1) word counts; (2) context-word counts, seating, totals; (3) every
document's tokens go to the owner of the word, which counts and seats again
from the training tokens it gets, and answers each chunk with sums for its
documents. Pairs of the bounded table are scored on the spot and don't travel.
What travels is combined inside each chunk first.

Defined results: NULL, empty and blank texts are the end token alone; repeated
rows count and score each; a NULL id is held out by the fold of the empty
text; an empty table gives an empty result; other columns are ignored. With no
training row all counts are 0 and words are unknown. Words compare by 64-bit
hashes.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscheck.llm import blobs
from corpuscheck.llm.tables import fold, narrow
from corpuscheck.llm.words import U64, Chunk, chunks, doc_of, hash_spans, mix, split_words
from corpuscheck.session import materialize

FOLDS, HELD_OUT = 7, 2
#: Training occurrences that give a history its own restaurant, a bound on those (none), and the fewest shared restaurants.
RECURRING, CONTEXTS, RARE_CLASSES = 2, None, 64
HOT_PAIRS = 200_000
DISCOUNT, STRENGTH = 0.8, 5.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.6, 10.0
SWEEPS, KEPT = 3, 2
#: Customers of a dish that are seated one by one.
SEATED = 16
BYTES_PER_PARTITION = 16_000_000
MAX_DOCS = 30_000
END, BEGIN = U64(0x517CC1B727220A95), U64(0x6C62272E07BB0142)

DIRECTORY, TOKENS, SUMS = 0, 1, 2


# --- randomness and restaurants ----------------------------------------------

def uniform(key: np.ndarray, step: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the key and the step alone."""
    return ((mix(key + U64((step * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)) >> U64(11)).astype(float) + 0.5) / (1 << 53)


def grow_tables(key: np.ndarray, customers: np.ndarray, rate: np.ndarray, discount: float, step: int) -> np.ndarray:
    """Tables of dishes after so many arrivals; ``rate``: the weight of a new table.

    Arrivals come in steps of an eighth of those seated; a step's new tables
    are rounded at random.
    """
    tables, seated = np.minimum(customers, 1).astype(float), np.minimum(customers, 1).astype(float)
    live = np.flatnonzero(customers > 1)
    k = 0
    while len(live):
        n, t, r = seated[live], tables[live], rate[live]
        more = np.minimum(np.maximum(1, n // 8), customers[live] - n)
        new = more * r / np.maximum(n - discount * t + r, 1e-12)
        whole = np.floor(new)
        new = np.minimum(whole + (uniform(key[live], 1000 * (step + 1) + k) < new - whole), more)
        tables[live], seated[live] = t + new, n + more
        live = live[seated[live] < customers[live]]
        k += 1
    return tables.astype(np.int64)


class Seats:
    """Gibbs seating of all dishes with an equal, small number of customers."""

    def __init__(self, key: np.ndarray, customers: int):
        self.key, self.c = key, customers
        self.seat = np.zeros((len(key), customers), np.int8)
        self.size = np.zeros((len(key), customers), np.int16)
        self.size[:, 0] = customers

    def sweep(self, rate: np.ndarray, discount: float, step: int) -> np.ndarray:
        rows = np.arange(len(self.key))
        for i in range(self.c):
            self.size[rows, self.seat[:, i]] -= 1
            weight = np.where(self.size > 0, self.size - discount, 0.0)
            total = np.cumsum(weight, axis=1)
            u = uniform(self.key, 64 * (step + 1) + i) * (total[:, -1] + rate)
            known = u < total[:, -1]
            choice = np.where(known, (total <= u[:, None]).sum(1), np.argmax(self.size == 0, axis=1))
            choice = np.minimum(choice, self.c - 1)
            self.seat[:, i] = choice
            self.size[rows, choice] += 1
        return (self.size > 0).sum(1)


def expected_tables(customers: np.ndarray, discount: float = DISCOUNT, strength: float = STRENGTH) -> np.ndarray:
    """Mean number of tables of a Pitman-Yor restaurant with so many customers."""
    from math import lgamma

    scale = np.exp(lgamma(strength + 1) - lgamma(strength + discount)) / discount
    c = np.maximum(customers, 0).astype(float)
    return np.minimum(scale * np.maximum((c + strength) ** discount - strength ** discount, 0) + (c > 0), c)


def seat_all(word: np.ndarray, key: np.ndarray, c: np.ndarray, tables_u: np.ndarray, count_w: np.ndarray, total: int,
             fixed: dict[int, np.ndarray] | None = None) -> np.ndarray:
    """Tables of every (context, word) row in each sweep.

    ``word`` numbers the rows' words, ``count_w`` has the training counts of
    those words, ``tables_u`` the rows' contexts' expected tables. Between
    sweeps a word's root share follows the tables it has. ``fixed``: rows whose
    tables are known from the pass before.
    """
    out = np.ones((SWEEPS, len(c)), np.int64)
    skip = np.zeros(len(c), bool)
    if fixed:
        skip[list(fixed)] = True
    groups = [(np.flatnonzero((c == k) & ~skip), k) for k in range(2, SEATED + 1)]
    groups = [(rows, Seats(key[rows], k)) for rows, k in groups if len(rows)]
    many = np.flatnonzero((c > SEATED) & ~skip)
    local = np.bincount(word, c, len(count_w))
    share = count_w / max(total, 1)
    for s in range(SWEEPS):
        rate = (STRENGTH + DISCOUNT * tables_u) * share[word]
        for rows, seats in groups:
            out[s, rows] = seats.sweep(rate[rows], DISCOUNT, s)
        out[s, many] = grow_tables(key[many], c[many], rate[many], DISCOUNT, s)
        for row, t in (fixed or {}).items():
            out[s, row] = t[s]
        tables = np.bincount(word, out[s], len(count_w)) * (count_w / np.maximum(local, 1))
        every = total * out[s].sum() / max(int(c.sum()), 1)
        share = np.maximum(tables - ROOT_DISCOUNT, 0.4) / (ROOT_STRENGTH + every)
    return out


def root_tables(word_key: np.ndarray, customers: np.ndarray, words: int, sweep: int) -> np.ndarray:
    rate = np.full(len(customers), (ROOT_STRENGTH + ROOT_DISCOUNT * words) / (words + 1))
    return grow_tables(word_key, customers, rate, ROOT_DISCOUNT, 50 + sweep)


# --- chunks -------------------------------------------------------------------

def tokens(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, token before it, document) of all tokens, the end tokens included."""
    starts, ends, first = split_words(chunk.data, chunk.bounds)
    h = hash_spans(chunk.data, starts, ends, lower=True)
    at = np.arange(len(h)) + doc_of(first)
    d = np.arange(len(chunk))
    token, prev = np.full(len(h) + len(chunk), END), np.full(len(h) + len(chunk), BEGIN)
    token[at] = h
    prev[at + 1] = h
    prev[first[:-1] + d] = BEGIN
    return token, prev, np.repeat(d, np.diff(first) + 1)


@dataclass
class Contexts:
    """The tokens with a restaurant of their own, by hash, and how often each is a history."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    salted: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    salted_count: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    buckets: int = 1
    pools: int = RARE_CLASSES

    def number(self, prev: np.ndarray) -> np.ndarray:
        k = np.minimum(np.searchsorted(self.keys, prev), max(len(self.keys) - 1, 0))
        own = self.keys[k] == prev if len(self.keys) else np.zeros(len(prev), bool)
        rare = (mix(prev) % U64(self.pools)).astype(np.int64) + len(self.keys)
        return np.where(prev == BEGIN, len(self.keys) + self.pools, np.where(own, k, rare))

    @property
    def size(self) -> int:
        return len(self.keys) + self.pools + 1

    @property
    def kind(self) -> type:
        """The type that context numbers travel in."""
        return np.uint16 if self.size <= 1 << 16 else np.uint32

    def without_keys(self) -> Contexts:
        """For tasks that get context numbers: the keys are the large part."""
        return replace(self, keys=np.zeros(0, U64))

    def is_salted(self, word: np.ndarray) -> np.ndarray:
        return np.isin(word, self.salted)

    def bucket(self, word: np.ndarray, ctx: np.ndarray) -> np.ndarray:
        """Owner of a word; of a word and context for the salted ones."""
        key = np.where(self.is_salted(word), word + mix(ctx.astype(U64) + U64(1)), word)
        return ((mix(key) >> U64(32)) * U64(self.buckets)) >> U64(32)


def pair_key(word: np.ndarray, ctx: np.ndarray) -> np.ndarray:
    return mix(word + mix(ctx.astype(U64) + U64(77)))


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of each run, length of each run) of equal neighbours."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    return at, np.diff(np.append(at, len(sorted_values)))


def _by_owner(buckets: int, bucket: np.ndarray, word: np.ndarray):
    """Order by (bucket, word), and where each bucket begins in it."""
    order = np.argsort((bucket << U64(44)) | (word >> U64(20)))
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=U64))


# --- pass 1: word counts --------------------------------------------------------

_COUNTS = "kind int, a long, b long, v array<double>"
_COUNT_SCHEMA = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("v", pa.list_(pa.float64()))])
TOTALS, WORDS, CONTEXT_TOTALS, ROOT_TOTALS, PAIRS = 0, 1, 2, 3, 4


def _rows(kind: int, a: np.ndarray, b: np.ndarray, v: np.ndarray):
    """Record batches of result rows; ``v`` has a row of numbers for each."""
    for i in range(0, len(a), 50_000):
        part = v[i:i + 50_000].astype(float)
        values = pa.ListArray.from_arrays(pa.array(np.arange(0, part.size + 1, max(part.shape[1], 1)), pa.int32()), pa.array(part.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int32)), pa.array(a[i:i + 50_000].astype(np.int64)),
                                          pa.array(b[i:i + 50_000].astype(np.int64)), values], schema=_COUNT_SCHEMA)


def word_counts(docs: DataFrame, partitions: int, least: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    """(training tokens, distinct, words at least so frequent, their counts); ``docs`` has ``held``."""

    def send(bs):
        def rows():
            for number, c in zip(blobs.chunk_numbers(), chunks(bs, max_docs=MAX_DOCS)):
                token, _, d = tokens(c)
                word, count = np.unique(token[~c.column("held")[d]], return_counts=True)
                at = ((word >> U64(32)) * U64(partitions)) >> U64(32)
                cuts = np.searchsorted(at, np.arange(partitions + 1, dtype=U64))
                for b in range(partitions):
                    i, j = cuts[b], cuts[b + 1]
                    if j > i:
                        yield b, number, TOKENS, blobs.pack(*blobs.shrink(word[i:j]), count[i:j].astype(np.uint32))

        yield from blobs.batches(rows())

    def add(bucket, rows):
        word, count = zip(*[(blobs.grow(a, g), n) for a, g, n in (blobs.unpack(r[3]) for r in rows)])
        word, count = np.concatenate(word), np.concatenate(count).astype(np.int64)
        order = np.argsort(word)
        word, count = word[order], count[order]
        at, _ = _runs(word)
        word, count = word[at], np.add.reduceat(count, at)
        yield from _rows(TOTALS, np.zeros(1), np.zeros(1), np.array([[count.sum(), len(word)]]))
        hot = count >= least
        yield from _rows(WORDS, word[hot].view(np.int64), np.zeros(hot.sum()), count[hot][:, None])

    found = materialize(blobs.reduce_buckets(docs.mapInArrow(send, blobs.SCHEMA), partitions, add, _COUNTS), "lm-words")
    total = found.filter(F.col("kind") == TOTALS).agg(F.sum(F.col("v")[0]), F.sum(F.col("v")[1])).first()
    top = found.filter(F.col("kind") == WORDS).select("a", F.col("v")[0].alias("n"))
    top = (top if CONTEXTS is None else top.orderBy(F.desc("n"), "a").limit(CONTEXTS)).toArrow()
    return int(total[0] or 0), int(total[1] or 0), top["a"].to_numpy().astype(np.int64).view(U64), top["n"].to_numpy().astype(np.int64)


# --- pass 2: seating ------------------------------------------------------------

def _merge(word: np.ndarray, ctx: np.ndarray, count: np.ndarray):
    """Distinct (word, context) rows in order, with their counts: (words, row's word number, context, count)."""
    words, number = np.unique(word, return_inverse=True)
    key = (number.astype(U64) << U64(32)) | ctx.astype(U64)
    order = np.argsort(key)
    key, count = key[order], count[order]
    at, _ = _runs(key)
    total = np.add.reduceat(count, at) if len(at) else count
    return words, (key[at] >> U64(32)).astype(np.int64), (key[at] & U64(0xFFFFFFFF)).astype(np.int64), total


def _word_counts(words: np.ndarray, number: np.ndarray, count: np.ndarray, ctxs: Contexts) -> np.ndarray:
    """Training counts of an owner's words: what it has, or the salted words' known ones."""
    out = np.bincount(number, count, len(words)).astype(np.int64)
    order = np.argsort(ctxs.salted)
    salted = ctxs.is_salted(words)
    if salted.any():
        out[salted] = ctxs.salted_count[order][np.searchsorted(ctxs.salted[order], words[salted])]
    return out


def seating_totals(docs: DataFrame, partitions: int, ctxs: Contexts, tables_u: np.ndarray, total: int, words_total: int, least: int) -> DataFrame:
    """Sums of all partitions' seatings: of contexts, salted words, the root, and the frequent pairs."""

    def send(bs):
        def rows():
            for number, c in zip(blobs.chunk_numbers(), chunks(bs, max_docs=MAX_DOCS)):
                token, prev, d = tokens(c)
                train = ~c.column("held")[d]
                words, n, ctx, count = _merge(token[train], ctxs.number(prev[train]), np.ones(train.sum(), np.int64))
                word = words[n]
                bucket = ctxs.bucket(word, ctx)
                order, cuts = _by_owner(ctxs.buckets, bucket, word)
                word, ctx, count = word[order], ctx[order].astype(ctxs.kind), count[order].astype(np.uint32)
                for b in range(ctxs.buckets):
                    i, j = cuts[b], cuts[b + 1]
                    if j > i:
                        at, size = _runs(word[i:j])
                        yield b, number, TOKENS, blobs.pack(word[i:j][at], size.astype(np.uint32), ctx[i:j], count[i:j])

        yield from blobs.batches(rows())

    owners = ctxs.without_keys()

    def seat(bucket, rows, ctxs=owners):
        word, ctx, count = zip(*[(np.repeat(w, n), u, c) for w, n, u, c in (blobs.unpack(r[3]) for r in rows)])
        words, number, ctx, count = _merge(np.concatenate(word), np.concatenate(ctx).astype(np.int64), np.concatenate(count).astype(np.int64))
        count_w = _word_counts(words, number, count, ctxs)
        t = seat_all(number, pair_key(words[number], ctx), count, tables_u[ctx], count_w, total)[-KEPT:]
        # by the contexts that the owner has, which don't grow with the corpus
        used, slot = np.unique(ctx, return_inverse=True)
        sums = np.stack([np.bincount(slot, count, len(used))] + [np.bincount(slot, x, len(used)) for x in t], axis=1)
        yield from _rows(CONTEXT_TOTALS, used, np.zeros(len(used)), sums)
        customers = np.stack([np.bincount(number, x, len(words)) for x in t]).astype(np.int64)
        salted = ctxs.is_salted(words)
        yield from _rows(ROOT_TOTALS, words[salted].view(np.int64), np.zeros(salted.sum()), customers[:, salted].T)
        own = ~salted
        roots = np.stack([root_tables(mix(words), x, words_total, s) for s, x in enumerate(customers)])
        yield from _rows(TOTALS, np.zeros(1), np.zeros(1), np.concatenate([customers[:, own].sum(1), roots[:, own].sum(1)])[None])
        hot = count >= least
        n = number[hot]
        every = seat_all(number, pair_key(words[number], ctx), count, tables_u[ctx], count_w, total)[:, hot] if hot.any() else t[:, hot]
        yield from _rows(PAIRS, words[n].view(np.int64), ctx[hot], np.column_stack(
            [count[hot], count_w[n], *every, *customers[:, n], *roots[:, n]]) if hot.any() else np.zeros((0, 2 + SWEEPS + 2 * KEPT)))

    return materialize(blobs.reduce_buckets(docs.mapInArrow(send, blobs.SCHEMA), partitions, seat, _COUNTS), "lm-seating")


# --- the model's bounded tables ----------------------------------------------------

@dataclass
class Model:
    ctxs: Contexts
    tokens: int
    words: int
    tables_u: np.ndarray             # expected tables, used while seating
    customers_u: np.ndarray          # training tokens after each context
    back_off: np.ndarray             # weight of the root in each context
    root: np.ndarray                 # all customers and tables of the root, for each kept sweep
    salted_root: np.ndarray          # the same of each salted word
    pair_word: np.ndarray
    pair_ctx: np.ndarray
    pair_rows: np.ndarray            # count, word's count, tables of each sweep
    pair_order: np.ndarray = None
    pair_keys: np.ndarray = None
    pair_log: np.ndarray = None

    def root_share(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Averaged probability of words in the root restaurant."""
        c, t = self.root
        rest = (ROOT_STRENGTH + ROOT_DISCOUNT * t[:, None]) / (self.words + 1)
        return ((np.maximum(customers - ROOT_DISCOUNT * tables, 0) + rest) / (ROOT_STRENGTH + c[:, None])).mean(0)

    def probability(self, ctx: np.ndarray, count: np.ndarray, t: np.ndarray, share: np.ndarray) -> np.ndarray:
        own = np.maximum(count - DISCOUNT * t, 0).mean(0) if len(t) else np.zeros(len(ctx))
        return own / (STRENGTH + self.customers_u[ctx]) + self.back_off[ctx] * share


def fit(docs: DataFrame, partitions: int, least: int = 1) -> Model:
    """The tables of the model; ``docs`` has ``(doc_id, text, held)``; tokens seen ``least`` times have their own restaurant."""
    total, words, hot, count = word_counts(docs, partitions, least)
    buckets = partitions
    heavy = count > max(total // (4 * buckets), 16)
    order = np.argsort(hot)
    hot, count, heavy = hot[order], count[order], heavy[order]
    ctxs = Contexts(hot[hot != END], hot[heavy], count[heavy], buckets, max(RARE_CLASSES, words - len(hot)))
    # every training token but the end is a history once, so a context's customers are its count
    own = count[hot != END]
    # each row has one end, and one history without a token
    ends = count[hot == END].sum()
    guess = np.concatenate([own, np.full(ctxs.pools, max(total - own.sum() - ends, 0) / ctxs.pools), [ends]])
    tables_u = expected_tables(guess).astype(np.float32)
    seated = seating_totals(docs, partitions, ctxs, tables_u, total, words, max(2, -(-total // HOT_PAIRS)))
    width = 1 + KEPT
    # as Arrow columns: the contexts' totals are as many as there are contexts
    per = (seated.filter(F.col("kind") == CONTEXT_TOTALS).groupBy("a").agg(*[F.sum(F.col("v")[k]).cast("float").alias(f"v{k}") for k in range(width)]).toArrow())
    sums = np.zeros((ctxs.size, width), np.float32)
    for k in range(width):
        sums[per["a"].to_numpy(), k] = per[f"v{k}"].to_numpy()
    del per
    customers_u = sums[:, 0].copy()
    back_off = ((STRENGTH + DISCOUNT * sums[:, 1:]) / (STRENGTH + customers_u[:, None])).mean(1)
    back_off = np.where(customers_u > 0, back_off, 1.0).astype(np.float32)
    roots = (seated.filter(F.col("kind") == ROOT_TOTALS).groupBy("a").agg(*[F.sum(F.col("v")[k]).alias(f"v{k}") for k in range(KEPT)]).toPandas())
    salted = np.zeros((2, KEPT, len(ctxs.salted)))
    if len(roots):
        at = np.searchsorted(ctxs.salted, roots["a"].to_numpy(np.int64).view(U64))
        salted[0][:, at] = roots[[f"v{k}" for k in range(KEPT)]].to_numpy().T
    for s in range(KEPT):
        salted[1, s] = root_tables(mix(ctxs.salted), salted[0, s].astype(np.int64), words, s)
    base = seated.filter(F.col("kind") == TOTALS).agg(*[F.sum(F.col("v")[k]) for k in range(2 * KEPT)]).first()
    root = np.array([float(x or 0) for x in base]).reshape(2, KEPT) + salted.sum(2)
    pairs = seated.filter(F.col("kind") == PAIRS).select("a", "b", "v").toPandas()
    rows = np.array(pairs["v"].to_list(), float).reshape(len(pairs), 2 + SWEEPS + 2 * KEPT)
    model = Model(ctxs, total, words, tables_u, customers_u, back_off, root, salted,
                  pairs["a"].to_numpy(np.int64).view(U64), pairs["b"].to_numpy(np.int64), rows[:, :2 + SWEEPS].astype(np.int64))
    is_salted = ctxs.is_salted(model.pair_word)
    c, t = rows[:, -2 * KEPT:-KEPT].T.copy(), rows[:, -KEPT:].T.copy()
    if is_salted.any():
        k = np.searchsorted(ctxs.salted, model.pair_word[is_salted])
        c[:, is_salted], t[:, is_salted] = salted[0][:, k], salted[1][:, k]
    p = model.probability(model.pair_ctx, rows[:, 0], rows[:, 2:2 + SWEEPS].T[-KEPT:], model.root_share(c, t))
    key = pair_key(model.pair_word, model.pair_ctx)
    model.pair_order = np.argsort(key)
    model.pair_keys = key[model.pair_order]
    model.pair_log = np.column_stack([np.log10(p), np.log10(rows[:, 1] + 1)])[model.pair_order] if len(key) else np.zeros((0, 2))
    return model


# --- pass 3: scores -----------------------------------------------------------------

def _score_bucket(model: Model, bucket: int, rows: list):
    """Sums of log probabilities of one owner's tokens, for each chunk's documents."""
    out, parts = [], []
    for _, chunk, kind, payload in rows:
        if kind == TOKENS:
            word, n, ctx, doc = blobs.unpack(payload)
            parts.append((chunk, np.repeat(word, n), ctx.astype(np.int64), doc))
        else:
            out.append((bucket, chunk, kind, payload))
    if parts:
        ctxs = model.ctxs
        word, ctx, doc = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
        words, number = np.unique(word, return_inverse=True)
        key = (number.astype(U64) << U64(32)) | ctx.astype(U64)
        train = (doc & 0x8000) == 0
        row_key, count = np.unique(key[train], return_counts=True)
        # pairs that are scored in their chunks take part in the seating
        mine = np.flatnonzero((ctxs.bucket(model.pair_word, model.pair_ctx) == U64(bucket)) & np.isin(model.pair_word, words)) \
            if len(model.pair_word) else np.zeros(0, np.int64)
        pair = (np.searchsorted(words, model.pair_word[mine]).astype(U64) << U64(32)) | model.pair_ctx[mine].astype(U64)
        all_keys = np.concatenate([row_key, pair])
        order = np.argsort(all_keys)
        all_keys, all_count = all_keys[order], np.concatenate([count, model.pair_rows[mine, 0]])[order]
        fixed = {int(np.searchsorted(all_keys, k)): model.pair_rows[m, 2:2 + SWEEPS] for k, m in zip(pair, mine)}
        n, u = (all_keys >> U64(32)).astype(np.int64), (all_keys & U64(0xFFFFFFFF)).astype(np.int64)
        count_w = _word_counts(words, n, all_count, ctxs)
        t = seat_all(n, pair_key(words[n], u), all_count, model.tables_u[u], count_w, model.tokens, fixed)[-KEPT:]
        customers = np.stack([np.bincount(n, x, len(words)) for x in t]).astype(float)
        tables = np.stack([root_tables(mix(words), x.astype(np.int64), model.words, s) for s, x in enumerate(customers)]).astype(float)
        salted = ctxs.is_salted(words)
        if salted.any():
            k = np.searchsorted(ctxs.salted, words[salted])
            customers[:, salted], tables[:, salted] = model.salted_root[0][:, k], model.salted_root[1][:, k]
        share = model.root_share(customers, tables)
        # distinct (word, context) of all tokens, seen in training or not
        asked, back = np.unique(key, return_inverse=True)
        an, au = (asked >> U64(32)).astype(np.int64), (asked & U64(0xFFFFFFFF)).astype(np.int64)
        at = np.minimum(np.searchsorted(all_keys, asked), max(len(all_keys) - 1, 0))
        seen = all_keys[at] == asked if len(all_keys) else np.zeros(len(asked), bool)
        p = model.probability(au, np.where(seen, all_count[at] if len(all_keys) else 0, 0),
                              np.where(seen, t[:, at], 0) if len(all_keys) else np.zeros((KEPT, len(asked))), share[an])
        log_p = np.log10(p)[back]
        log_c = np.log10(count_w + 1)[number]
        known = (count_w > 0)[number]
        at = 0
        for chunk, w, _, d in parts:
            some = slice(at, at + len(w))
            docs, d = np.unique(d & 0x7FFF, return_inverse=True)
            out.append((bucket, chunk, SUMS, blobs.pack(
                docs.astype(np.uint16), np.bincount(d, log_p[some]).astype(np.float32), np.bincount(d, log_c[some]).astype(np.float32),
                np.bincount(d, known[some]).astype(np.uint32))))
            at += len(w)
    yield from blobs.batches(iter(out))


_SCORES = "doc_id long, held boolean, n_tokens long, n_known long, log_counts double, score double"


def _add_up(chunk: int, rows: list):
    """A chunk's documents with the sums of all owners' answers."""
    ids, has_id, held, n, known, log_c, log_p = next(blobs.unpack(r[3]) for r in rows if r[2] == DIRECTORY)
    known, log_c, log_p = known.astype(np.int64), log_c.astype(float), log_p.astype(float)
    for r in rows:
        if r[2] == SUMS:
            d, p, c, k = blobs.unpack(r[3])
            log_p[d] += p
            log_c[d] += c
            known[d] += k
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids, mask=~has_id), pa.array(held), pa.array(n), pa.array(known), pa.array(log_c), pa.array(log_p)],
        names=["doc_id", "held", "n_tokens", "n_known", "log_counts", "score"])


def score(docs: DataFrame, model: Model, partitions: int) -> DataFrame:
    """Scores of all documents under the model; ``docs`` has ``(doc_id, text, held)``."""
    # tasks get the parts of the model they use
    ctxs, pair_keys, pair_log = model.ctxs, model.pair_keys, model.pair_log
    owned = replace(model, ctxs=ctxs.without_keys(), pair_order=None, pair_keys=None, pair_log=None)

    def send(bs):
        def rows():
            for number, c in zip(blobs.chunk_numbers(), chunks(bs, max_docs=MAX_DOCS)):
                token, prev, d = tokens(c)
                held = c.column("held")
                ctx = ctxs.number(prev)
                key = pair_key(token, ctx)
                k = np.minimum(np.searchsorted(pair_keys, key), max(len(pair_keys) - 1, 0))
                done = pair_keys[k] == key if len(pair_keys) else np.zeros(len(key), bool)
                logs = pair_log[k[done]] if done.any() else np.zeros((0, 2))
                ids = c.rows.column("doc_id")
                yield number % ctxs.buckets, number, DIRECTORY, blobs.pack(
                    ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(), held, np.bincount(d, minlength=len(c)),
                    np.bincount(d[done], minlength=len(c)), np.bincount(d[done], logs[:, 1], len(c)), np.bincount(d[done], logs[:, 0], len(c)))
                word, ctx, d = token[~done], ctx[~done], d[~done]
                bucket = ctxs.bucket(word, ctx)
                order, cuts = _by_owner(ctxs.buckets, bucket, word)
                doc = (d + np.where(held[d], 0x8000, 0)).astype(np.uint16)[order]
                word, ctx = word[order], ctx[order].astype(ctxs.kind)
                for b in range(ctxs.buckets):
                    i, j = cuts[b], cuts[b + 1]
                    if j > i:
                        at, size = _runs(word[i:j])
                        yield b, number, TOKENS, blobs.pack(word[i:j][at], size.astype(np.uint32), ctx[i:j], doc[i:j])

        yield from blobs.batches(rows())

    def answer(bucket, rows):
        yield from _score_bucket(owned, bucket, rows)

    answered = blobs.reduce_buckets(docs.mapInArrow(send, blobs.SCHEMA), partitions, answer)
    return blobs.reduce_buckets(answered, partitions, _add_up, _SCORES, key="chunk")


def score_documents(docs: DataFrame) -> DataFrame:
    """Base and model scores of all documents; those of fold ``HELD_OUT`` are not learned from."""
    docs = narrow(docs).withColumn("held", fold(F.col("doc_id"), FOLDS) == HELD_OUT)
    total_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    floor = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total_bytes = total_bytes or 0
    partitions = max(min(floor, 1 + total_bytes // 1_000_000), 1 + total_bytes // BYTES_PER_PARTITION)
    model = fit(docs, partitions, RECURRING)
    scale = float(np.log10(model.tokens + model.words + 1))
    return score(docs, model, partitions).select(
        "doc_id", F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * F.lit(scale)).alias("base_score"), "score")


def op2_hpylm(spark, sf_dir: str) -> DataFrame:
    """Base and Pitman-Yor scores of every document of ``documents``."""
    from corpuscheck.llm.tables import read

    return score_documents(read(spark, sf_dir, "documents"))
