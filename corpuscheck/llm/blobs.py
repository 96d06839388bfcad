"""Packed exchanges: many small records travel as a few binary rows.

A map task sorts the records of one chunk by key and cuts them into buckets;
each (chunk, bucket) is one row ``(bucket, chunk, kind, payload)``. Spark
partitions, sorts and shuffles these rows as any others; a reducer sees the
rows of one bucket at a time. The number of buckets follows the input's size,
so a bucket stays small whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text bytes behind one reducer partition.
BYTES_PER_PARTITION = 8_000_000


def text_partitions(docs: DataFrame, text: str = "text", per: int = BYTES_PER_PARTITION) -> int:
    """Reducer partitions for work on all words of ``docs`` (one column scan)."""
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    floor = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(min(floor, 1 + total // 500_000), 1 + int(total // per))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays end to end, after their lengths and types."""
    head = [len(arrays)]
    body = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head += [ord(a.dtype.kind), a.dtype.itemsize, len(a)]
        body.append(a.tobytes())
    return np.array(head, np.int64).tobytes() + b"".join(body)


def unpack(payload: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(payload, np.int64, 1)[0])
    head = np.frombuffer(payload, np.int64, 3 * n, 8).reshape(n, 3)
    at, out = 8 + 24 * n, []
    for kind, width, count in head:
        dtype = np.dtype(f"{chr(kind)}{width}")
        out.append(np.frombuffer(payload, dtype, int(count), at))
        at += int(width) * int(count)
    return out


def shrink(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first key, gaps) of ascending keys; gaps take 4 bytes where they fit."""
    if len(sorted_keys) == 0:
        return sorted_keys[:0], np.zeros(0, np.uint32)
    gaps = np.diff(sorted_keys)
    return sorted_keys[:1], gaps.astype(np.uint32) if len(gaps) == 0 or gaps.max() < (1 << 32) else gaps


def grow(first: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    if len(first) == 0:
        return first.astype(np.uint64)
    return np.cumsum(np.concatenate([first.astype(np.uint64), gaps.astype(np.uint64)]), dtype=np.uint64)


SCHEMA = "bucket long, chunk long, kind int, payload binary"
_ARROW = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])


def batch(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)


def batches(rows: Iterator[tuple[int, int, int, bytes]], max_bytes: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Record batches of a few MB from single rows."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3])
        if size >= max_bytes or len(held) >= 2000:
            yield batch(held)
            held, size = [], 0
    if held:
        yield batch(held)


def chunk_numbers() -> Iterator[int]:
    """Numbers of a task's chunks, unique over the stage and the same on a retry."""
    from pyspark import TaskContext

    base = TaskContext.get().partitionId() << 24
    yield from range(base, base + (1 << 24))


def by_bucket(rows: DataFrame, partitions: int, key: str = "bucket") -> DataFrame:
    """Shuffle packed rows so that each bucket is read in one run."""
    return rows.repartition(partitions, F.col(key)).sortWithinPartitions(key, "kind")


def groups(record_batches: Iterator[pa.RecordBatch], key: str = "bucket") -> Iterator[tuple[int, list[tuple[int, int, int, bytes]]]]:
    """(key, its rows) from rows sorted by key."""
    held, now = [], None
    k = {"bucket": 0, "chunk": 1}[key]
    for b in record_batches:
        cols = [b.column(n).to_pylist() for n in ("bucket", "chunk", "kind", "payload")]
        for row in zip(*cols):
            if held and row[k] != now:
                yield now, held
                held = []
            now = row[k]
            held.append(row)
    if held:
        yield now, held


def reduce_buckets(rows: DataFrame, partitions: int, fn: Callable, schema: str = SCHEMA, key: str = "bucket") -> DataFrame:
    """``fn(key, rows) -> record batches`` over every bucket (or chunk)."""

    def run(bs):
        for k, held in groups(bs, key):
            yield from fn(k, held)

    return by_bucket(rows, partitions, key).mapInArrow(run, schema)
