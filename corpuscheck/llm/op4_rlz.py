"""Substring dedup by relative Lempel-Ziv parsing against the corpus itself.

The reference is the corpus, cut into blocks of 20 consecutive words at every
word. Every block is indexed under its anchor: the smallest hash among the
8-word grams inside it, frequent grams last. Equal blocks have equal anchors,
so an index partition (a range of anchors) sees all occurrences of its blocks
and answers each later one with a place where it stands earlier (under a
smaller doc_id, or earlier in the same document). Frequent grams (a table of
bounded size, from a pass of their own over all documents) anchor only blocks
that have nothing else, so the many different surroundings of a common passage
are spread by their own words.

A document is parsed from left to right: at a word whose block has a source
the factor ``(start, words, source, source start)`` goes on as long as the next
block's source is the next place of the same document; other words are
literals, and the parse resumes behind a factor. So every factor has 20 words
at least and is a copy of its source. Blocks that begin inside a factor and end
behind it are checked at that boundary: those with a source of their own are
duplicates too. A document's duplicate spans are its factors and these blocks.

Plan: one pass hashes the words of each chunk, folds runs of blocks that
occur in the chunk already (only the earliest travels; a passage that a third
of all documents share costs one record for each chunk), and sends packed runs
by anchor; the index partition answers with the later occurrences and their
sources, neighbours with neighbouring sources as one piece; the pieces meet the
documents again by id, and each document is parsed by itself.

Defined results: NULL, empty and blank texts have no words and the hash of the
empty string; texts under 20 words lose nothing; rows with the same id are
judged each on its own text, and equal starts under the same id are not
earlier than each other; a NULL id counts as the smallest; an empty table
gives an empty result; other columns are ignored. Blocks compare by 103 hash
bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscheck.llm import blobs
from corpuscheck.llm.tables import narrow
from corpuscheck.llm.words import U64, Chunk, chunks, hash_spans, mix, roll, split_words, windows

BLOCK_WORDS = 20
ANCHOR_WORDS = 8
#: Runs of an anchor in a chunk that make it a candidate for a frequent gram.
RECURS = 16
#: Most frequent grams there can be (an anchor's run has at least two bytes of
#: text to itself), and the least number of runs that makes one.
FREQUENT, FREQUENT_LEAST = 200_000, 64
_NO_ID = -(1 << 63)

RUNS, PIECES = 0, 1


def _anchors(h: np.ndarray, k: int, block: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the block at each word: its smallest ``k``-gram hash, frequent ones last, and where that starts (leftmost)."""
    value = roll(h, k) >> U64(1)
    value |= np.isin(value, frequent).astype(U64) << U64(63)
    at = np.arange(len(value), dtype=np.int64)
    width = block - k + 1

    def narrower(value, at, step):
        n = len(value) - step
        left = value[:n] <= value[step:]
        return np.where(left, value[:n], value[step:]), np.where(left, at[:n], at[step:])

    have = 1
    while have < width:
        step = min(have, width - have)
        value, at = narrower(value, at, step)
        have += step
    return value, at


def frequent_grams(docs: DataFrame, least: int, block: int = BLOCK_WORDS) -> np.ndarray:
    """Sorted grams that anchor at least ``least`` runs, of those that recur inside a chunk.

    ``least`` bounds their number: the callers' is a fixed share of all words.
    """
    k = min(ANCHOR_WORDS, block)

    def count(bs):
        for c in chunks(bs):
            starts, ends, first = split_words(c.data, c.bounds)
            h = hash_spans(c.data, starts, ends)
            at, d = windows(first, block)
            if not len(at):
                continue
            value, where = _anchors(h, k, block, np.zeros(0, U64))
            value, where = value[at], where[at]
            head = np.ones(len(at), bool)
            head[1:] = (where[1:] != where[:-1]) | (d[1:] != d[:-1])
            gram, n = np.unique(value[head], return_counts=True)
            often = n >= RECURS
            yield pa.RecordBatch.from_pydict({"gram": gram[often].view(np.int64), "n": n[often]})

    rows = (docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= least).select("gram").toPandas())
    return np.sort(rows["gram"].to_numpy(np.int64).view(U64))


def _send(chunk: Chunk, number: int, buckets: int, block: int, frequent: np.ndarray):
    ids = chunk.rows.column("doc_id").fill_null(_NO_ID).to_numpy()
    fps = chunk.rows.column("fp").to_numpy()
    starts, ends, first = split_words(chunk.data, chunk.bounds)
    h = hash_spans(chunk.data, starts, ends)
    at, d = windows(first, block)
    if not len(at):
        return
    k = min(ANCHOR_WORDS, block)
    value, where = _anchors(h, k, block, frequent)
    value, where = value[at], where[at]
    whole = roll(h, block)[at]
    # a run: neighbouring blocks of a document under one occurrence of an anchor
    head = np.ones(len(at), bool)
    head[1:] = (where[1:] != where[:-1]) | (d[1:] != d[:-1])
    run = np.flatnonzero(head)
    size = np.diff(np.append(run, len(at)))
    anchor, doc, pos = value[run], d[run], at[run] - first[d[run]]
    # equal runs of this chunk: only the earliest goes on, later ones are known duplicates
    key = mix(anchor + mix(np.add.reduceat(whole, run)) + size.astype(U64))
    order = np.lexsort((pos, ids[doc], key))
    lead = np.ones(len(order), bool)
    lead[1:] = key[order][1:] != key[order][:-1]
    leader = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
    later = np.zeros(len(order), bool)
    later[order] = (ids[doc[order]] != ids[doc[leader]]) | (pos[order] != pos[leader])
    if later.any():
        # an equal run that is later than its leader is copied from it as a whole
        of = np.empty(len(order), np.int64)
        of[order] = leader
        of = of[later]
        yield number % buckets, number, PIECES, blobs.pack(ids[doc[later]], fps[doc[later]], pos[later].astype(np.uint32), size[later].astype(np.uint32),
                                                           ids[doc[of]], fps[doc[of]].astype(np.int32), pos[of].astype(np.uint32))
    left = np.flatnonzero(~later)
    left = left[np.argsort(anchor[left], kind="stable")]
    spread = mix(anchor[left]) >> U64(32)
    bucket = (spread * U64(buckets)) >> U64(32)
    order = np.argsort(bucket, kind="stable")
    left, bucket = left[order], bucket[order]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=U64))
    for b in range(buckets):
        mine = left[cuts[b]:cuts[b + 1]]
        if not len(mine):
            continue
        n = size[mine]
        inner = np.repeat(run[mine], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        w = whole[inner]
        docs, local = np.unique(doc[mine], return_inverse=True)
        yield b, number, RUNS, blobs.pack(ids[docs], fps[docs], anchor[mine], local.astype(np.uint16), pos[mine].astype(np.uint32),
                                          n.astype(np.uint8), (w >> U64(32)).astype(np.uint32), (w >> U64(24)).astype(np.uint8))


#: ``blocks`` neighbouring blocks from ``start`` on stand earlier, from ``source_start`` of the row ``(source_id, source_fp)`` on.
_PIECE = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("start", pa.int32()), ("blocks", pa.int32()),
                    ("source_id", pa.int64()), ("source_fp", pa.int32()), ("source_start", pa.int32())])
_PIECE_DDL = "doc_id long, fp long, start int, blocks int, source_id long, source_fp int, source_start int"


def _piece_batch(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(columns, _PIECE)], schema=_PIECE)


def _lookup(bucket: int, rows: list):
    """Pieces of the blocks of one anchor range that occur earlier elsewhere, with their sources."""
    parts, base = [], 0
    for _, _, kind, payload in rows:
        if kind == PIECES:
            yield _piece_batch(*blobs.unpack(payload))
        else:
            ids, fps, anchor, local, pos, n, high, low = blobs.unpack(payload)
            parts.append((ids, fps, anchor, local.astype(np.int64) + base, pos, n, (high.astype(U64) << U64(8)) | low.astype(U64)))
            base += len(ids)
    if not parts:
        return
    ids, fps, anchor, doc, pos, n, whole = (np.concatenate(x) for x in zip(*parts))
    n = n.astype(np.int64)
    tokens, back, count = np.unique(anchor, return_inverse=True, return_counts=True)
    often = count[back] > 1
    if not often.any():
        return
    run = np.flatnonzero(often)
    begin = np.cumsum(n) - n
    size = n[run]
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    key = mix(whole[np.repeat(begin[run], size) + step] + mix(np.repeat(anchor[run], size)))
    doc, pos = np.repeat(doc[run], size), np.repeat(pos[run].astype(np.int64), size) + step
    order = np.lexsort((pos, ids[doc], key))
    key, doc, pos = key[order], doc[order], pos[order]
    lead = np.ones(len(key), bool)
    lead[1:] = key[1:] != key[:-1]
    leader = np.maximum.accumulate(np.where(lead, np.arange(len(key)), 0))
    later = (ids[doc] != ids[doc[leader]]) | (pos != pos[leader])
    source, source_pos = doc[leader][later], pos[leader][later]
    doc, pos = doc[later], pos[later]
    if not len(doc):
        return
    order = np.lexsort((pos, doc))
    doc, pos, source, source_pos = doc[order], pos[order], source[order], source_pos[order]
    head = np.ones(len(doc), bool)
    head[1:] = (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1) | (source[1:] != source[:-1]) | (source_pos[1:] != source_pos[:-1] + 1)
    begin = np.flatnonzero(head)
    yield _piece_batch(ids[doc[begin]], fps[doc[begin]], pos[begin], np.diff(np.append(begin, len(doc))),
                       ids[source[begin]], fps[source[begin]].astype(np.int32), source_pos[begin])


def matches(docs: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """Pieces ``(doc_id, fp, start, blocks, source_id, source_fp, source_start)`` of neighbouring blocks with a source.

    ``docs`` has ``(doc_id, fp, text)``; ``fp`` tells rows of one id apart. A
    NULL id is the smallest number here.
    """
    partitions = blobs.text_partitions(docs)
    buckets = 2 * partitions
    # every run has bytes of its own, so at most FREQUENT grams reach this count
    frequent = frequent_grams(docs, max(FREQUENT_LEAST, partitions * blobs.BYTES_PER_PARTITION // FREQUENT), block)

    def send(bs):
        for number, c in zip(blobs.chunk_numbers(), chunks(bs)):
            yield from blobs.batches(_send(c, number, buckets, block, frequent))

    return blobs.reduce_buckets(docs.mapInArrow(send, blobs.SCHEMA), partitions, _lookup, _PIECE_DDL)


def parse(start: np.ndarray, blocks: np.ndarray, source_id: np.ndarray, source_fp: np.ndarray, source_start: np.ndarray,
          block: int = BLOCK_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Greedy factors of one document from its pieces, and the blocks at their boundaries.

    Factors are rows ``(start, words, source id, source start)`` in order,
    without overlap; the second array has the first words of the blocks that
    reach over the end of a factor and have a source.
    """
    # every block with a source, once (rows that repeat an id and a text answer alike)
    step = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    pos = np.repeat(start.astype(np.int64), blocks) + step
    of = np.repeat(np.arange(len(start)), blocks)
    at = source_start.astype(np.int64)[of] + step
    order = np.lexsort((at, source_fp[of], source_id[of], pos))
    order = order[np.concatenate([[True], np.diff(pos[order]) > 0])] if len(order) else order
    pos, of, at = pos[order], of[order], at[order]
    goes_on = ((np.diff(pos) == 1) & (np.diff(at) == 1) & (source_id[of[1:]] == source_id[of[:-1]]) & (source_fp[of[1:]] == source_fp[of[:-1]]))
    stops = np.append(np.flatnonzero(~goes_on), len(pos) - 1)
    found, over = [], [np.zeros(0, np.int64)]
    i = 0
    while i < len(pos):
        last = int(stops[np.searchsorted(stops, i)])
        end = int(pos[last]) + block
        found.append((pos[i], end - pos[i], source_id[of[i]], at[i]))
        i = int(np.searchsorted(pos, end))
        over.append(pos[last + 1:i])
    return np.array(found, np.int64).reshape(len(found), 4), np.concatenate(over)


_PARTS = ("start", "blocks", "source_id", "source_fp", "source_start")


def _pieces_by_row(docs: DataFrame, block: int) -> DataFrame:
    return matches(docs, block).groupBy("doc_id", "fp").agg(F.collect_list(F.struct(*_PARTS)).alias("pieces"))


def _pieces(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """The pieces of one row after another, as arrays; rows without any have empty ones."""
    flat = column.flatten()
    arrays = [pc.struct_field(flat, [k]).to_numpy() for k in range(len(_PARTS))]
    at = np.concatenate([[0], np.cumsum(pc.list_value_length(column).fill_null(0).to_numpy())])
    for i, j in zip(at[:-1], at[1:]):
        yield [a[i:j] for a in arrays]


def _with_fp(docs: DataFrame) -> DataFrame:
    return narrow(docs).withColumn("fp", F.xxhash64(F.coalesce("text", F.lit(""))))


def factors(docs: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, start, words, source_id, source_start)``: the factors of every document, in words from 0.

    Documents without factors have no row, those with one id and one text have theirs once.
    """

    def run(bs):
        for b in bs:
            out = [parse(*p, block)[0] for p in _pieces(b.column("pieces"))]
            rows = np.concatenate(out) if out else np.zeros((0, 4), np.int64)
            ids = np.repeat(b.column("doc_id").to_numpy(), [len(x) for x in out])
            yield pa.RecordBatch.from_arrays([pa.array(ids, mask=ids == _NO_ID), pa.array(rows[:, 0]), pa.array(rows[:, 1]),
                                              pa.array(rows[:, 2], mask=rows[:, 2] == _NO_ID), pa.array(rows[:, 3])],
                                             names=["doc_id", "start", "words", "source_id", "source_start"])

    return _pieces_by_row(_with_fp(docs), block).mapInArrow(run, "doc_id long, start long, words long, source_id long, source_start long")


def remove_duplicates(docs: DataFrame, block: int = BLOCK_WORDS, texts: bool = False) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, n_factors)`` of every document; ``texts`` adds ``kept_text``."""
    docs = _with_fp(docs)
    pieces = _pieces_by_row(docs, block).withColumnRenamed("doc_id", "row_id")
    joined = (docs.withColumn("row_id", F.coalesce("doc_id", F.lit(_NO_ID)))
              .join(pieces, ["row_id", "fp"], "left").select("doc_id", "text", "pieces"))
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "n_factors"] + ["kept_text"] * texts

    def run(bs):
        for b in bs:
            n, gone, digest, count, kept = [], [], [], [], []
            for text, mine in zip(b.column("text"), _pieces(b.column("pieces"))):
                words = (text.as_py() or "").encode().split()
                n.append(len(words))
                found, over = parse(*mine, block)
                count.append(len(found))
                if len(found):
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, np.concatenate([found[:, 0], over]), 1)
                    np.add.at(cover, np.concatenate([found[:, 0] + found[:, 1], over + block]), -1)
                    keep = np.cumsum(cover)[:-1] == 0
                    words = [words[j] for j in np.flatnonzero(keep)]
                gone.append(n[-1] - len(words))
                out = b" ".join(words)
                digest.append(hashlib.sha256(out).hexdigest())
                if texts:
                    kept.append(out.decode())
            cols = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string()), pa.array(count, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.string())] * texts, names=names)

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, n_factors long" + ", kept_text string" * texts)


def op4_rlz_dedup(spark, sf_dir: str) -> DataFrame:
    """Duplicate words of every document of ``documents``."""
    from corpuscheck.llm.tables import read

    return remove_duplicates(read(spark, sf_dir, "documents")).drop("n_factors")


SQL = """
WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
blocks AS MATERIALIZED (SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS k FROM w, unnest(range(1, len(w) - 18)) AS t(p)),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS r FROM blocks) WHERE r > 1),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, p + o AS pos FROM later, range(0, 20) AS t(o)),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""
