"""Benchmark decontamination by pigeonhole edit matching.

An item is its words, lower-cased and stripped of outer punctuation. With an
error budget of ``k`` word edits it is split into ``k + 1`` pieces: a passage
within ``k`` edits of the item keeps at least one piece unchanged. Documents
are scanned for exact hits of the pieces' leading words; every hit is verified
with Myers' bit-parallel distance over words, in the window around the hit
that any match of at most ``k`` edits must lie in.

The budget is one edit for every ``WORDS_PER_EDIT`` words, so every piece has
at least that many words (an item of fewer words must occur whole). Items are
read in blocks of ``BLOCK_ITEMS``; a block is the only thing sent to all
tasks and its size is bounded by that parameter and by ``BLOCK_CHARS``; more
blocks mean more passes, never a larger broadcast. Documents aren't shuffled.
Passes are chained over the same rows, in one stage: each has a Python worker
and a block of its own in every task.

Defined results: NULL, empty or blank texts match nothing, nor do items
without words; an empty benchmark leaves every document clean; items with
equal words match together; repeated rows are judged alike; NULL ids are kept;
other columns are ignored (``matches``) or passed on (``keep_documents``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscheck.llm.tables import narrow
from corpuscheck.llm.words import U64, Chunk, chunks, hash_spans, roll, split_words, text_buffers, windows

WORDS_PER_EDIT = 5
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 16_000_000

_ASCII_MARK = np.zeros(256, bool)
_ASCII_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True


def word_codes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text); words of marks alone don't count."""
    starts, ends, first = split_words(data, bounds)
    starts, ends = starts.copy(), ends.copy()
    live = np.arange(len(starts))
    while len(live):
        live = live[(starts[live] < ends[live])]
        live = live[_ASCII_MARK[data[starts[live]]]]
        starts[live] += 1
    live = np.arange(len(starts))
    while len(live):
        live = live[(starts[live] < ends[live])]
        live = live[_ASCII_MARK[data[ends[live] - 1]]]
        ends[live] -= 1
    left = starts < ends
    kept = np.concatenate([[0], np.cumsum(left)])
    return hash_spans(data, starts[left], ends[left], lower=True), kept[first]


def budget(words: int) -> int:
    return max(0, words // WORDS_PER_EDIT - 1)


def pieces(words: int) -> list[int]:
    """Where the pieces of an item of so many words begin."""
    parts = budget(words) + 1
    return [i * words // parts for i in range(parts)]


class ItemIndex:
    """Pieces of one block of items, and their words as bit masks."""

    def __init__(self, items: list[tuple[int, str]]):
        data, bounds = text_buffers(pa.array([t or "" for _, t in items], pa.string()))
        h, first = word_codes(data, bounds)
        self.ids = [i for i, _ in items]
        self.words = [h[first[k]:first[k + 1]] for k in range(len(items))]
        self.masks: list[dict[int, int]] = []
        by_width: dict[int, list[tuple[int, int, int]]] = {}
        for k, w in enumerate(self.words):
            mask: dict[int, int] = {}
            for i, x in enumerate(w.tolist()):
                mask[x] = mask.get(x, 0) | 1 << i
            self.masks.append(mask)
            if len(w):
                width = min(len(w), WORDS_PER_EDIT)
                codes = roll(w, width)
                for at in pieces(len(w)):
                    by_width.setdefault(width, []).append((int(codes[at]), k, at))
        self.by_width = {}
        for width, found in by_width.items():
            found.sort()
            self.by_width[width] = (np.array([f[0] for f in found], U64), np.array([f[1] for f in found]), np.array([f[2] for f in found]))


def myers(mask: dict[int, int], m: int, text: list[int], most: int) -> tuple[int, int]:
    """(fewest edits, where that match ends) of a pattern of ``m`` words anywhere in ``text``.

    ``mask`` has the pattern's positions of each word as bits; the vertical
    differences of a whole column are two integers, updated at once.
    """
    top, full = 1 << (m - 1), (1 << m) - 1
    plus, minus, score = full, 0, m
    best, end = most + 1, -1
    for j, word in enumerate(text):
        eq = mask.get(word, 0)
        x = eq | minus
        d0 = (((eq & plus) + plus) ^ plus) | x
        hp = minus | (~(d0 | plus) & full)
        hn = plus & d0
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        # the first row is all zeros: a match may begin anywhere
        hp, hn = (hp << 1) & full, (hn << 1) & full
        plus = hn | (~(d0 | hp) & full)
        minus = hp & d0
        if score < best:
            best, end = score, j
    return best, end


def find(chunk: Chunk, index: ItemIndex) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, item, edits, first word, end word) of the best match of each document and item."""
    h, first = word_codes(chunk.data, chunk.bounds)
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    for width, (codes, items, offsets) in index.by_width.items():
        at, d = windows(first, width)
        got = roll(h, width)[at]
        lo, hi = np.searchsorted(codes, got), np.searchsorted(codes, got, "right")
        hit = np.flatnonzero(lo < hi)
        tried: set[tuple[int, int, int]] = set()
        for p in hit.tolist():
            for k in range(int(lo[p]), int(hi[p])):
                item, doc = int(items[k]), int(d[p])
                m = len(index.words[item])
                most = budget(m)
                begin = int(at[p]) - int(offsets[k])
                # hits of several pieces of one passage lie on one diagonal
                if (item, doc, begin) in tried:
                    continue
                tried.add((item, doc, begin))
                a, b = max(int(first[doc]), begin - most), min(int(first[doc + 1]), begin + m + most)
                edits, end = myers(index.masks[item], m, h[a:b].tolist(), most)
                if edits <= most and (edits, a) < found.get((doc, item), (m + 1, 0, 0))[:2]:
                    found[doc, item] = (edits, a, a + end + 1)
    for (doc, item), (edits, a, end) in sorted(found.items()):
        m = len(index.words[item])
        yield doc, index.ids[item], edits, max(a, end - m - edits) - int(first[doc]), end - int(first[doc])


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The items with words, in blocks of bounded size, fetched one block at a time."""
    rows = (benchmark.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text).cast("string").alias("text"))
            .filter(F.col("text").isNotNull()))
    held, size = [], 0
    for row in rows.toLocalIterator():
        if held and (len(held) >= BLOCK_ITEMS or size + len(row["text"]) > BLOCK_CHARS):
            yield sorted(held, key=lambda r: (r[0] is None, r))
            held, size = [], 0
        held.append((row["item_id"], row["text"]))
        size += len(row["text"])
    if held:
        yield sorted(held, key=lambda r: (r[0] is None, r))


_MATCHES = "doc_id long, item_id long, edits int, first_word int, end_word int"


def _block_matches(docs: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
    def run(bs):
        index = ItemIndex(items)
        for c in chunks(bs):
            ids = c.rows.column("doc_id").to_pylist()
            rows = [(ids[d], *rest) for d, *rest in find(c, index)]
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, [pa.int64()] * 2 + [pa.int32()] * 3)],
                                             names=["doc_id", "item_id", "edits", "first_word", "end_word"])

    return docs.mapInArrow(run, _MATCHES)


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, edits, first_word, end_word)``: the best match of each item in each document that has one.

    Word numbers count the document's words without those of marks alone.
    """
    docs = narrow(docs)
    out = None
    for items in item_blocks(benchmark):
        part = _block_matches(docs, items)
        out = part if out is None else out.unionAll(part)
    return docs.sparkSession.createDataFrame([], _MATCHES) if out is None else out


_STATE = "doc_id long, n_items long, best_item long, edits int"


def _best(n: np.ndarray, best: list, edits: list, found: Iterator[tuple[int, int, int, int, int]]) -> None:
    """Counts ``found`` in and keeps the item of fewest edits; of equal ones the smallest id, NULL last."""
    for d, item, e, _, _ in found:
        n[d] += 1
        if edits[d] is None or (e, item is None, item or 0) < (edits[d], best[d] is None, best[d] or 0):
            best[d], edits[d] = item, e


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, contaminated, n_items, best_item, edits)`` of every row of ``docs``; a pass for each block."""
    rows = narrow(docs).withColumns({"n_items": F.lit(0).cast("long"), "best_item": F.lit(None).cast("long"), "edits": F.lit(None).cast("int")})
    blocks = item_blocks(benchmark)
    items = next(blocks, None)
    while items is not None:
        following = next(blocks, None)

        # a row stays a row: its text goes on as long as there are blocks to come
        def run(bs, items=items, last=following is None):
            index = ItemIndex(items)
            for b in bs:
                at = 0
                for c in chunks(iter([b])):
                    part = b.slice(at, len(c))
                    n, best, edits = part.column("n_items").to_numpy(zero_copy_only=False).copy(), part.column("best_item").to_pylist(), part.column("edits").to_pylist()
                    _best(n, best, edits, find(c, index))
                    cols = [part.column("doc_id"), pa.array(n), pa.array(best, pa.int64()), pa.array(edits, pa.int32())]
                    names = ["doc_id", "n_items", "best_item", "edits"]
                    yield pa.RecordBatch.from_arrays(cols if last else [*cols, part.column("text")], names=names if last else [*names, "text"])
                    at += len(c)

        rows = rows.mapInArrow(run, _STATE if following is None else f"{_STATE}, text string")
        items = following
    return rows.select("doc_id", (F.col("n_items") > 0).alias("contaminated"), "n_items", "best_item", "edits")


def keep_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns unchanged; a pass for each block."""
    for items in item_blocks(benchmark):

        def run(bs, items=items):
            index = ItemIndex(items)
            for b in bs:
                at = 0
                for c in chunks(iter([b]), text):
                    keep = np.ones(len(c), bool)
                    keep[[d for d, *_ in find(c, index)]] = False
                    yield b.slice(at, len(c)).filter(pa.array(keep))
                    at += len(c)

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark matches of every document of ``documents``."""
    from corpuscheck.llm.tables import read

    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
