"""Best-fit packing with bound-certified repacking.

``pieces`` tokenises whole texts (a byte-level BPE file, its path is a
parameter) and cuts only what is longer than a sequence. ``pack`` spreads the
pieces over partitions of a bounded number of pieces, packs each best-fit
decreasing, and compares its number of sequences with lower bounds from
dual-feasible functions. Sequences without a gap are final. While the total
is over the bound of all pieces, the partitions give the pieces of sequences
with gaps back, exchange them (another salt, fewer partitions) and run again;
a round that doesn't save a sequence ends it.

Tokenising looks every distinct blank-led piece of text up once: the BPE's
pre-tokeniser never matches across a single space between two other
characters, nor from an ASCII letter to a mark other than the apostrophe, so the
ids of a text are those of its parts end to end.

Defined results: a NULL or empty text is the single id 0; rows with the same
id are packed each on their own; a NULL id is kept as NULL; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscheck.llm.op13_pieces import PartIds
from corpuscheck.llm.tables import narrow
from corpuscheck.llm.words import Chunk, chunks, hash_spans
from corpuscheck.session import materialize

CAPACITY = 2048
#: Pieces that one partition packs.
PARTITION_PIECES = 50_000
ROUNDS = 4
#: Distinct parts of texts whose ids a Python worker remembers, in each of two generations.
CACHE_PARTS = 400_000
#: Bytes of text tokenised at once.
CHUNK_BYTES = 8_000_000
END = 0

_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[ord(c) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
# ASCII marks but the apostrophe; those that a special token's text holds stay with their neighbours.
_MARK[[ord(c) for c in "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"]] = True


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """A tokenizer file, as ``PartIds`` asks for it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        tokens, count = [], []
        for i in range(0, len(parts), 20_000):
            for e in self.tokenizer.encode_batch(parts[i:i + 20_000], add_special_tokens=False):
                ids = e.ids
                tokens += ids
                count.append(len(ids))
        return np.array(tokens, np.uint32), np.array(count, np.int64)

    def ids(self, tokens: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tokens, count


def part_ids(path: str) -> PartIds:
    """This Python process's remembered ids; they outlive a task, not the worker."""
    import tokenizers

    held = vars(tokenizers).setdefault("_part_ids", {})
    if path not in held:
        held[path] = PartIds(Encoder(path), CACHE_PARTS)
    return held[path]


def token_ids(chunk: Chunk, memory: PartIds) -> tuple[np.ndarray, np.ndarray]:
    """(ids end to end without the end marks, first id of each document)."""
    data, bounds = chunk.data, chunk.bounds
    if not len(data):
        return np.zeros(0, np.uint32), np.zeros(len(chunk) + 1, np.int64)
    solid = data > 0x20
    cut = np.zeros(len(data), bool)
    cut[1:-1] = (data[1:-1] == 0x20) & solid[:-2] & solid[2:] & ((data[:-2] < 0x7F) | (data[2:] < 0x7F))
    # a run of letters ends at a mark, but for the apostrophe, and the mark starts a run of marks
    cut[1:] |= _LETTER[data[:-1]] & _MARK[data[1:]]
    # a part may not reach over a document's edge
    edge = bounds[(bounds > 0) & (bounds < len(data))]
    cut[edge] = True
    cut[0] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(data))
    keys, sample, back = np.unique(hash_spans(data, start, end), return_index=True, return_inverse=True)
    at, n, held = memory.find(keys, lambda k: data[start[sample[k]]:end[sample[k]]].tobytes().decode("utf-8", "replace"))
    size = n[back]
    total = np.concatenate([[0], np.cumsum(size)])
    ids = held[np.repeat(at[back] - total[:-1], size) + np.arange(total[-1])]
    return ids, total[np.searchsorted(start, bounds)]


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: its document's ids before it, its length and the crc32 of its ids."""

    def run(bs: Iterator[pa.RecordBatch]):
        memory = part_ids(path)
        for c in chunks(bs, max_bytes=CHUNK_BYTES):
            ids, first = token_ids(c, memory)
            n = np.diff(first) + 1
            count = -(-n // capacity)
            doc = np.repeat(np.arange(len(c)), count)
            piece = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            lead = n - (count - 1) * capacity
            start = np.where(piece == 0, 0, lead[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, lead[doc], capacity)
            crc = np.empty(len(doc), np.int64)
            end = np.array([END], np.uint32).tobytes()
            for k in range(len(doc)):
                d, s = doc[k], start[k]
                body = ids[first[d] + s:min(first[d] + s + length[k], first[d + 1])].astype("<u4").tobytes()
                crc[k] = zlib.crc32(body + end if piece[k] == count[d] - 1 else body)
            yield pa.RecordBatch.from_arrays(
                [c.rows.column("doc_id").combine_chunks().take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                 pa.array(length), pa.array(crc)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return narrow(docs).mapInArrow(run, _PIECES)


def lower_bound(count: np.ndarray, capacity: int = CAPACITY) -> int:
    """Fewest sequences for ``count[s]`` pieces of each length ``s``, by dual-feasible functions.

    Two families: lengths over ``capacity - e`` count as whole sequences and
    those under ``e`` as nothing; and lengths rounded to multiples of 1 / k.
    """
    s = np.arange(len(count), dtype=np.int64)
    c = count.astype(np.int64)
    best = -(-int((c * s).sum()) // capacity)
    total, pieces_ = np.cumsum(c * s), np.cumsum(c)
    for e in range(1, capacity // 2 + 1):
        big = int(pieces_[-1] - pieces_[capacity - e])
        mid = int(total[capacity - e] - total[e - 1])
        best = max(best, big + -(-mid // capacity))
    for k in range(1, 33):
        whole = (k + 1) * s
        value = np.where(whole % capacity == 0, s * k, (whole // capacity) * capacity)  # times k
        best = max(best, -(-int((c * value).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(length: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, and each sequence's fill.

    Open sequences are listed by the room they have; a bit mask of the rooms
    in use finds the tightest fit at once.
    """
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, fill = 0, []
    seq, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
    for i in np.argsort(-length, kind="stable").tolist():
        s = int(length[i])
        fits = mask >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                mask ^= 1 << r
        else:
            r, b = capacity, len(fill)
            fill.append(0)
        seq[i], offset[i] = b, fill[b]
        fill[b] += s
        if r > s:
            room[r - s].append(b)
            mask |= 1 << (r - s)
    return seq, offset, np.array(fill, np.int64)


_PACKED = _PIECES + ", sequence_id long, offset long, fill long, bound long, sequences long"


def _pack_round(left: DataFrame, groups: int, salt: int, capacity: int) -> DataFrame:
    names = [f.strip().split()[0] for f in _PACKED.split(",")]

    def close(key: int, held: list[pa.RecordBatch]):
        table = pa.Table.from_batches(held).combine_chunks()
        length = table.column("length").to_numpy()
        seq, offset, fill = best_fit_decreasing(length, capacity)
        bound = lower_bound(np.bincount(length, minlength=capacity + 1), capacity)
        n = len(length)
        cols = [table.column(c) for c in names[:5]]
        new = [(salt << 56) + (key << 24) + seq, offset, fill[seq], np.full(n, bound), np.full(n, len(fill))]
        return pa.Table.from_arrays(cols + [pa.array(x) for x in new], names=names).combine_chunks().to_batches(max_chunksize=20_000)

    def run(bs):
        held, now = [], None
        for b in bs:
            keys = b.column("g").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            for i, j in zip(cuts[:-1], cuts[1:]):
                if i == j:
                    continue
                if held and keys[i] != now:
                    yield from close(now, held)
                    held = []
                now = int(keys[i])
                held.append(b.slice(i, j - i))
        if held:
            yield from close(now, held)

    g = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(salt)), F.lit(groups))
    return (left.withColumn("g", g).repartition(groups, "g").sortWithinPartitions("g", "length", "doc_id", "piece")
            .mapInArrow(run, _PACKED))


def pack(rows: DataFrame, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` of ``pieces`` with ``sequence_id`` and ``offset``."""
    rows = materialize(rows, "packing-pieces")
    spread = rows.groupBy("length").agg(F.count(F.lit(1)).alias("c")).toPandas()  # at most ``capacity`` rows
    if not len(spread):
        return rows.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    count = np.zeros(capacity + 1, np.int64)
    count[spread["length"]] = spread["c"]
    bound = lower_bound(count, capacity)
    final, left, n_left, n_final = [], rows, int(count.sum()), 0
    before = None
    for k in range(rounds):
        packed = materialize(_pack_round(left, max(1, -(-n_left // partition_pieces)), k, capacity), "packing-round")
        total, full = packed.filter("offset = 0").agg(
            F.count(F.lit(1)), F.sum(F.when(F.col("fill") == capacity, 1).otherwise(0))).first()
        if before is not None and n_final + total >= before[0]:
            final.append(before[1])
            break
        if n_final + total <= bound or k == rounds - 1:
            final.append(packed)
            break
        before = (n_final + total, packed.filter(F.col("fill") < capacity))
        final.append(packed.filter(F.col("fill") == capacity))
        n_final += int(full or 0)
        left = packed.filter(F.col("fill") < capacity).select(*rows.columns)
        n_left = left.count()
        if not n_left:
            break
    out = final[0]
    for more in final[1:]:
        out = out.unionAll(more)
    return out.select(*rows.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    return pack(pieces(docs, path or tokenizer_path()))


def op8_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All of ``documents`` in as few sequences of 2,048 tokens as it can."""
    from corpuscheck.llm.tables import read

    return pack_documents(read(spark, sf_dir, "documents"))
