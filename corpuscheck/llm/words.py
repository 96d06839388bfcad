"""Byte-level words, word hashes and text chunks for Arrow batches.

A *word* is a maximal run of bytes other than 0x20 and 0x09-0x0D. All
separators are ASCII, so splitting UTF-8 bytes equals splitting code points.
Everything works on the Arrow buffers of a whole chunk of documents at once;
memory is bounded by the chunk size, not by the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64

#: Bytes of text per chunk, and documents per chunk (document numbers fit 16 bits).
CHUNK_BYTES = 8_000_000
CHUNK_DOCS = 60_000

#: Bytes hashed at once; bounds the power tables and the running sums.
_BLOCK = 1 << 20

_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15 | 1


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mixer (the public murmur3 constants)."""
    h = h ^ (h >> U64(33))
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


_TABLE = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
_LOWER = _TABLE.copy()
_LOWER[ord("A"):ord("Z") + 1] = _TABLE[ord("a"):ord("z") + 1]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, U64)
        p[:1] = 1
        out.append(np.cumprod(p, dtype=U64))
    return out[0], out[1]


@dataclass
class Chunk:
    """Documents of one chunk: their rows, and their UTF-8 bytes end to end."""

    rows: pa.Table
    data: np.ndarray      # uint8
    bounds: np.ndarray    # int64, one more than there are documents

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def column(self, name: str) -> np.ndarray:
        return self.rows.column(name).to_numpy()

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i]:self.bounds[i + 1]].tobytes()


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string column; NULL counts as empty."""
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", max_bytes: int = CHUNK_BYTES,
           max_docs: int = CHUNK_DOCS) -> Iterator[Chunk]:
    """Regroup Arrow batches into chunks of about ``max_bytes`` of text.

    A single longer document makes a chunk of its own.
    """
    held: list[pa.RecordBatch] = []
    size = docs = 0

    def flush() -> Chunk:
        table = pa.Table.from_batches(held).combine_chunks()
        col = table.column(text)
        col = col.chunk(0) if col.num_chunks else pa.array([], col.type)
        data, bounds = text_buffers(col)
        return Chunk(table.drop_columns([text]), data, bounds)

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            _, bounds = text_buffers(batch.column(text).slice(at))
            fit = int(np.searchsorted(bounds, max(max_bytes - size, 0), "right")) - 1
            take = min(max(fit, 0 if held else 1), max_docs - docs, batch.num_rows - at)
            if take > 0:
                held.append(batch.slice(at, take))
                size += int(bounds[take])
                docs += take
                at += take
            if at < batch.num_rows or size >= max_bytes or docs >= max_docs:
                yield flush()
                held, size, docs = [], 0, 0
    if held:
        yield flush()


def split_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) byte offsets of every word, and each document's first word."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    sep = _SEP[data]
    inner = ~sep
    begin = inner.copy()
    begin[1:] &= sep[:-1]
    at = bounds[:-1][bounds[:-1] < len(data)]
    begin[at] = inner[at]
    finish = inner
    last = inner[-1]
    edge = bounds[1:][bounds[1:] > 0] - 1
    keep = inner[edge].copy()
    finish[:-1] &= sep[1:]
    finish[-1] = last
    finish[edge] = keep
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, bounds)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each byte span; spans are in order and don't overlap."""
    table = _LOWER if lower else _TABLE
    out = np.empty(len(starts), U64)
    power = inverse = np.zeros(0, U64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + _BLOCK, "right")))
        part = data[base:ends[j - 1]]
        if len(power) <= len(part):
            power, inverse = _power_tables(max(len(part) + 1, min(_BLOCK, len(data)) + 1))
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(table[part] * power[:len(part)], out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (total[e] - total[s]) * inverse[s]
        i = j
    # the length keeps spans apart whose bytes hash alike
    return mix(out + (ends - starts).astype(U64) * U64(0xA24BAED4963EE407))


def roll(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive entries (document bounds are the caller's)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for i in range(k):
        out = (out + h[i:i + n]) * U64(0x2545F4914F6CDD1D) + U64(i + 1)
        if i % 5 == 4:
            out ^= out >> U64(29)
    return mix(out)


def doc_of(first: np.ndarray) -> np.ndarray:
    """Document number of every word."""
    return np.repeat(np.arange(len(first) - 1, dtype=np.int64), np.diff(first))


def windows(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, document) of every window of ``k`` words inside one document."""
    d = doc_of(first)
    at = np.arange(len(d), dtype=np.int64)
    ok = at + k <= first[1:][d]
    return at[ok], d[ok]
