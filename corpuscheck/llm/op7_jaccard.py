"""N-gram Jaccard join by multiple-global-order filtering.

A document is the set of its distinct 5-word shingles; two documents link when
``100 * intersection >= 75 * union``. A pair over the threshold must share a
token inside the first ``n - ceil(0.75 n) + 1`` tokens of both sets under ANY
global token order. The orders here all put tokens of a single document first
(they can't be shared), then sort the rest by document frequency (order one)
or by two different hashes (orders two and three). Pairs come from order one
and must also meet under the others before they are verified exactly.

Plan:

1. Every chunk of documents sends its (token, document) records packed by
   token range; a reducer counts document frequencies and answers each chunk
   with its shared tokens only. A document with fewer than 75 % shared
   shingles has no partner and drops out here. Tokens that are frequent inside
   a chunk stay with the chunk and send a marker, so no reducer collects the
   postings of a token that a large share of the corpus holds.
2. Equal sets fall together to one representative (a grouped minimum).
3. Representatives meet the smallest document of each prefix token's list
   ("star" candidates, linear in the postings) and the verified links merge;
   then only lists that still hold several components give pairs, across
   components, under size and position bounds. No list of linked copies is
   ever expanded to all its pairs.
4. Components of the links, joined back to the representatives' copies.

Defined results: NULL, empty or blank texts have no shingles and link with
nothing; fewer than five words are one shingle; rows with the same id are one
node; a NULL id is one node of its own that is reported as NULL; an empty
table gives an empty result; other columns are ignored. Tokens are 48-bit hashes of 64-bit word hashes; within a
pair of 1,000 shingles a false match has a chance of 1 in 10**8.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscheck.llm import blobs
from corpuscheck.llm.components import connected_components
from corpuscheck.llm.tables import narrow
from corpuscheck.llm.words import U64, Chunk, chunks, doc_of, hash_spans, mix, roll, split_words, windows
from corpuscheck.session import materialize

SHINGLE = 5
#: Documents link at 75 of 100.
PERCENT = 75
#: A token in so many documents of a chunk is kept there.
HOT = 64
_HOT_CLASS = np.uint32(0xFFFFFFFF)
_NO_ID = -(1 << 63)

DIRECTORY, MARKER, POSTING, KEPT = 0, 1, 2, 3


def needed(n: np.ndarray) -> np.ndarray:
    """Least intersection of a set of ``n`` with any partner: ceil(0.75 n)."""
    return (PERCENT * n + 99) // 100


def shingles(chunk: Chunk) -> np.ndarray:
    """Sorted distinct ``token48 << 16 | document`` of a chunk."""
    starts, ends, first = split_words(chunk.data, chunk.bounds)
    h = hash_spans(chunk.data, starts, ends, lower=True)
    at, d = windows(first, SHINGLE)
    parts = [(roll(h, SHINGLE)[at] & ~U64(0xFFFF)) | d.astype(U64)]
    n = np.diff(first)
    for k in range(1, SHINGLE):
        short = np.flatnonzero(n == k)
        if len(short):
            parts.append((mix(roll(h, k)[first[short]] + U64(k)) & ~U64(0xFFFF)) | short.astype(U64))
    return np.unique(np.concatenate(parts))


def _fingerprints(packed: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each document's tokens that don't depend on their order."""
    d = (packed & U64(0xFFFF)).astype(np.int64)
    m = mix(packed >> U64(16))
    low = np.bincount(d, (m & U64(0xFFFFFFFF)).astype(float), docs)
    high = np.bincount(d, (m >> U64(32)).astype(float), docs)
    return low.astype(np.int64), high.astype(np.int64)


def _send(chunk: Chunk, number: int, buckets: int):
    packed = shingles(chunk)
    d = (packed & U64(0xFFFF)).astype(np.int64)
    n = np.bincount(d, minlength=len(chunk)).astype(np.int64)
    ids = chunk.rows.column("doc_id").fill_null(_NO_ID).to_numpy()
    yield number % buckets, number, DIRECTORY, blobs.pack(ids, n, *_fingerprints(packed, len(chunk)))

    token = packed >> U64(16)
    edge = np.flatnonzero(np.diff(token, prepend=token[:1] - U64(1))) if len(token) else np.zeros(0, np.int64)
    size = np.diff(np.append(edge, len(token)))
    hot = size >= HOT
    if hot.any():
        mine = np.repeat(hot, size)
        yield number % buckets, number, KEPT, blobs.pack(token[mine], d[mine].astype(np.uint16))
        marks = token[edge[hot]]
        at = ((marks >> U64(16)) * U64(buckets)) >> U64(32)
        for b in np.unique(at):
            yield int(b), number, MARKER, blobs.pack(marks[at == b])
        token, d = token[~mine], d[~mine]
    # buckets are ranges of the token, so each is one slice
    at = ((token >> U64(16)) * U64(buckets)) >> U64(32)
    cuts = np.searchsorted(at, np.arange(buckets + 1, dtype=U64))
    small = d.astype(np.uint16)
    for b in range(buckets):
        i, j = cuts[b], cuts[b + 1]
        if j > i:
            yield b, number, POSTING, blobs.pack(*blobs.shrink(token[i:j]), small[i:j])


def _count(bucket: int, rows: list):
    """Document frequencies of one token range, answered chunk by chunk."""
    postings, marks, out = [], [], []
    for _, chunk, kind, payload in rows:
        if kind == POSTING:
            first, gaps, d = blobs.unpack(payload)
            postings.append((chunk, blobs.grow(first, gaps), d))
        elif kind == MARKER:
            marks.append(blobs.unpack(payload)[0])
        else:
            out.append((bucket, chunk, kind, payload))
    if postings:
        every = np.concatenate([t for _, t, _ in postings])
        tokens, df = np.unique(every, return_counts=True)
        df = df.astype(np.uint32)
        if marks:
            df[np.isin(tokens, np.unique(np.concatenate(marks)))] = _HOT_CLASS
        tokens, df = tokens[df > 1], df[df > 1]
        if len(tokens):
            for chunk, t, d in postings:
                k = np.minimum(np.searchsorted(tokens, t), len(tokens) - 1)
                shared = tokens[k] == t
                if shared.any():
                    out.append((bucket, chunk, POSTING, blobs.pack(t[shared], d[shared], df[k[shared]])))
    yield from blobs.batches(iter(out))


_SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("tokens", pa.binary())])
_SETS_DDL = "doc_id long, n long, fp1 long, fp2 long, tokens binary"


def _sets(chunk: int, rows: list):
    """Each document of a chunk; ``tokens``: its shared tokens in order one, if it can have a partner."""
    tokens, docs, df = [np.zeros(0, U64)], [np.zeros(0, np.uint16)], [np.zeros(0, np.uint32)]
    directory = []
    for _, _, kind, payload in rows:
        if kind == DIRECTORY:
            directory.append(blobs.unpack(payload))
        elif kind == KEPT:
            t, d = blobs.unpack(payload)
            tokens.append(t), docs.append(d), df.append(np.full(len(t), _HOT_CLASS))
        else:
            t, d, f = blobs.unpack(payload)
            tokens.append(t), docs.append(d), df.append(f)
    ids, n, fp1, fp2 = directory[0]
    t, d, f = np.concatenate(tokens), np.concatenate(docs).astype(np.int64), np.concatenate(df)
    shared = np.bincount(d, minlength=len(ids))
    live = (n > 0) & (shared >= needed(n))
    mine = live[d]
    t, d, f = t[mine], d[mine], f[mine]
    order = np.lexsort((t, f, d))
    t, d = t[order], d[order]
    cut = np.searchsorted(d, np.arange(len(ids) + 1))
    for i in range(0, len(ids), 2000):
        j = min(i + 2000, len(ids))
        body = [t[cut[k]:cut[k + 1]].tobytes() if live[k] else None for k in range(i, j)]
        yield pa.RecordBatch.from_arrays([pa.array(ids[i:j]), pa.array(n[i:j]), pa.array(fp1[i:j]), pa.array(fp2[i:j]),
                                          pa.array(body, pa.binary())], schema=_SETS)


def shared_sets(docs: DataFrame) -> DataFrame:
    """``(doc_id, n, fp1, fp2, tokens)`` of every document (written once)."""
    docs = narrow(docs)
    partitions = blobs.text_partitions(docs)
    buckets = 2 * partitions

    def send(bs):
        for number, c in zip(blobs.chunk_numbers(), chunks(bs)):
            yield from blobs.batches(_send(c, number, buckets))

    sent = docs.mapInArrow(send, blobs.SCHEMA)
    answered = blobs.reduce_buckets(sent, partitions, _count)
    return materialize(blobs.reduce_buckets(answered, partitions, _sets, _SETS_DDL, key="chunk"), "jaccard-sets")


_PREFIX = "tok long, doc long, n long, pos long"


def _prefixes(reps: DataFrame) -> DataFrame:
    """Prefix tokens of order one with their positions in the whole set."""

    def run(bs):
        for b in bs:
            ids, n = b.column("doc_id").to_numpy(), b.column("n").to_numpy()
            tok, doc, size, pos = [], [], [], []
            for i, body in enumerate(b.column("tokens").to_pylist()):
                t = np.frombuffer(body, np.int64)
                alone = int(n[i]) - len(t)
                take = int(n[i] - needed(n[i])) + 1 - alone
                if take > 0:
                    tok.append(t[:take])
                    doc.append(np.full(take, ids[i]))
                    size.append(np.full(take, n[i]))
                    pos.append(np.arange(alone, alone + take))
            if tok:
                yield pa.RecordBatch.from_pydict({k: np.concatenate(v) for k, v in (("tok", tok), ("doc", doc), ("n", size), ("pos", pos))})

    return reps.select("doc_id", "n", "tokens").mapInArrow(run, _PREFIX)


def _meet(x: np.ndarray, y: np.ndarray, nx: int, ny: int) -> bool:
    """Do two sets share a prefix token under the two hash orders?"""
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        ranks = []
        for t, n in ((x, nx), (y, ny)):
            take = int(n - needed(np.int64(n))) + 1 - (n - len(t))
            m = mix(t ^ U64(salt))
            ranks.append(np.partition(m, take - 1)[:take] if take < len(m) else m)
        if not len(np.intersect1d(*ranks, assume_unique=True)):
            return False
    return True


def _verify(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that are links; sets are joined to the pairs, never collected."""
    side = lambda k: reps.select(F.col("doc_id").alias(k), F.col("n").alias(f"n{k}"), F.col("tokens").alias(f"t{k}"))

    def run(bs):
        for batch in bs:
            a, b = [], []
            cols = [batch.column(c).to_pylist() for c in ("a", "b", "na", "nb", "ta", "tb")]
            for i, j, ni, nj, ti, tj in zip(*cols):
                x, y = np.frombuffer(ti, U64), np.frombuffer(tj, U64)
                if not _meet(x, y, ni, nj):
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= PERCENT * (ni + nj - both):
                    a.append(i), b.append(j)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ta", "tb")
            .mapInArrow(run, "a long, b long"))


def _across(tagged: DataFrame) -> DataFrame:
    """Meetings ``(tok, a, b)`` in the prefix lists of sets from different components that can be links.

    The smaller set of a link shares ``ceil(2 t / (1 + t) n)`` of its tokens at
    least, so its first common one stands in a shorter index prefix; only that
    part of a list is met. Tokens behind it, such as those of a text that makes
    up most of many documents, bring no two sets together.
    """
    least = F.expr(f"pos <= n - ceil(n * {2 * PERCENT} / {100 + PERCENT})")
    x, y = tagged.alias("x"), tagged.filter(least).alias("y")
    needs = f"ceil((x.n + y.n) * {PERCENT} / {100 + PERCENT})"
    return (x.join(y, F.expr("x.tok = y.tok and (x.n > y.n or x.n = y.n and x.doc > y.doc) and x.c <> y.c "
                             f"and 100 * y.n >= {PERCENT} * x.n and least(x.n - x.pos, y.n - y.pos) >= {needs}"))
            .select(F.col("x.tok").alias("tok"), F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")))


def links(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(representatives of equal sets, components of their links)."""
    live = sets.filter(F.col("tokens").isNotNull())
    classes = live.groupBy("fp1", "fp2", "n").agg(F.min("doc_id").alias("rep"))
    classes = materialize(classes, "jaccard-classes")
    reps = live.join(classes, ["fp1", "fp2", "n"]).filter(F.col("doc_id") == F.col("rep"))
    reps = materialize(reps.select("doc_id", "n", "fp1", "fp2", "tokens").dropDuplicates(["doc_id", "fp1", "fp2", "n"]), "jaccard-reps")
    prefixes = materialize(_prefixes(reps), "jaccard-prefixes")

    # lists of one are no use; the band keeps stars among sets of like size
    band = F.floor(F.log("n") / F.log(F.lit(4 / 3)))
    listed = prefixes.withColumn("band", band)
    hubs = (listed.groupBy("tok", "band").agg(F.min("doc").alias("hub"), F.count(F.lit(1)).alias("size"))
            .filter("size > 1").drop("size"))
    star = (listed.join(hubs, ["tok", "band"]).filter("doc <> hub")
            .select(F.col("doc").alias("a"), F.col("hub").alias("b")).distinct())
    first = materialize(_verify(star, reps), "jaccard-star")
    merged = connected_components(first)

    # what is left: lists that still hold several components
    tagged = (prefixes.join(merged, prefixes["doc"] == merged["node"], "left")
              .select("tok", "doc", "n", "pos", F.coalesce("component", "doc").alias("c")))
    open_lists = tagged.groupBy("tok").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("tok")
    tagged = materialize(tagged.join(open_lists, "tok", "left_semi"), "jaccard-open")
    # the links found so far lie inside components, so none of them comes back
    second = materialize(_verify(_across(tagged).select("a", "b").distinct(), reps), "jaccard-rest")
    final = connected_components(first.unionAll(second))
    return classes, final


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every document."""
    sets = shared_sets(docs)
    classes, components = links(sets)
    known = (classes.join(components, classes["rep"] == components["node"], "left")
             .select("fp1", "fp2", "n", F.coalesce("component", "rep").alias("component_id")))
    show = lambda c: F.when(F.col(c) != F.lit(_NO_ID), F.col(c))
    live = sets.filter(F.col("tokens").isNotNull()).select("doc_id", "n", "fp1", "fp2").join(known, ["fp1", "fp2", "n"], "left")
    rest = sets.filter(F.col("tokens").isNull()).select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return (live.select("doc_id", "n", "component_id").unionAll(rest)
            .select(show("doc_id").alias("doc_id"), F.col("n").alias("n_shingles"), show("component_id").alias("component_id")))


def op7_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document of ``documents``."""
    from corpuscheck.llm.tables import read

    return jaccard_components(read(spark, sf_dir, "documents"))


SQL = """
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM w),
t AS MATERIALIZED (SELECT doc_id, unnest(g) AS g FROM s),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM t x JOIN t y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM c JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
  WHERE 100 * n >= 75 * (len(x.g) + len(y.g) - n)),
sym AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(a, b) AS (SELECT a, a FROM sym UNION SELECT r.a, sym.b FROM reach r JOIN sym ON r.b = sym.a),
root AS (SELECT a AS doc_id, min(b) AS root FROM reach GROUP BY a)
SELECT doc_id, len(g) AS n_shingles, coalesce(root, doc_id) AS component_id FROM s LEFT JOIN root USING (doc_id)
"""
