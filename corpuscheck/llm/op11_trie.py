"""Prefix trie of conversations: sorted sequences, neighbours' common prefixes, and range minima.

Conversations, as sequences of turns, are sorted; L[j] is how many turns row j
shares with the row before. A prefix of d turns of row j is held by the rows
around j between which no L is under d. A sparse table holds the minimum of L
over every run of 2 ** k rows, and each candidate prefix searches its left and
its right end in it by halving steps, by itself, with no stack. Members, leaves,
children and saved characters of a node are then sums over its interval, taken
as differences of running sums; its smallest member is a second range minimum.

How it is spread: turns are 128-bit hashes and lengths from where they are read
on; texts don't travel. The sort is a range partition by (sequence, id), so
equal conversations and those that share a first turn lie in as many
partitions as they fill. Each partition is cut into chunks of a bounded number
of turns, a row each, that know what they share with the chunks before and
after; where partitions meet, that is found by a join of their first and last
rows. A node inside a chunk is whole; one that reaches over its end is open:
its parts, keyed by a hash of the prefix, are summed by Spark and come back to
the chunks, of which the first one that holds the node gives its row. Chunks
have at most as many open nodes as they share turns with their neighbours.

``rebuilt`` puts the first turns of another conversation before one's own.

Defined results: NULL roles and texts are empty; a NULL turn comes first; turns
of one number come in the order of their hash, repeated rows one after the
other; rows without an id belong to no conversation and are left out; an empty
table has no conversation, thus no node; other columns are ignored. A
conversation is handled whole as 20 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscheck.session import materialize

#: Conversations that share a lead, and the longest lead (what the query rebuilds).
LEAD_GROUP, LEAD_TURNS = 100, 6
#: Turns and conversations of a chunk; a longer conversation is a chunk of its own.
CHUNK_TURNS, CHUNK_ROWS = 100_000, 25_000
KEY = 16
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


# --- sequences --------------------------------------------------------------

def sequences(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: each conversation's ``(hash of role and text, code points of the text)`` in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(F.col("turn").cast("bigint").alias("turn"), F.unhex(key).alias("key"), F.length(text).alias("chars")).alias("t"))
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return held.select("conv_id", F.expr("transform(t, x -> named_struct('key', x.key, 'chars', x.chars))").alias("turns"))


def rebuilt(seqs: DataFrame, group: int = LEAD_GROUP, lead: int = LEAD_TURNS) -> DataFrame:
    """Every conversation with its first h turns replaced by those of conversation ``c - c % group``; h = crc32(c) % lead."""
    seqs = materialize(seqs, "trie-sequences")
    leads = (seqs.filter(F.col("conv_id") % group == 0)
             .select(F.col("conv_id").alias("_lead"), F.expr(f"slice(turns, 1, {lead - 1})").alias("_first")))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % lead).cast("int")
    both = (seqs.withColumn("_h", h).withColumn("_of", F.col("conv_id") - F.col("conv_id") % group)
            .join(leads, F.col("_of") == F.col("_lead"), "left"))
    own = "IF(size(turns) > _h, slice(turns, _h + 1, size(turns)), slice(turns, 1, 0))"
    return both.select("conv_id", F.expr(f"concat(slice(coalesce(_first, slice(turns, 1, 0)), 1, _h), {own})").alias("turns"))


# --- chunks of the sorted order ---------------------------------------------

def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many turns two sequences of hashes share at their start."""
    n = min(len(a), len(b))
    differ = np.flatnonzero((a[:n] != b[:n]).any(axis=1))
    return int(differ[0]) if len(differ) else n


def _hashes(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint64).reshape(-1, 2)


_CHUNK = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("ids", pa.binary()), ("lengths", pa.binary()), ("chars", pa.binary()),
                    ("keys", pa.binary()), ("before", pa.int64()), ("after", pa.int64()), ("first", pa.binary()), ("last", pa.binary())])
_CHUNK_DDL = ("part int, chunk int, ids binary, lengths binary, chars binary, keys binary, before long, after long, first binary, last binary")


def _cut(batches: Iterator[pa.RecordBatch], turns: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows as chunks; ``before`` and ``after`` are NULL at the partition's ends, which ``first`` and ``last`` show."""
    part = TaskContext.get().partitionId()
    held: list[tuple[int, bytes, list[int]]] = []
    size = number = 0
    before = None

    def close(after):
        nonlocal held, size, number, before
        keys = [k for _, k, _ in held]
        row = (part, number, np.array([i for i, _, _ in held], np.int64).tobytes(), np.array([len(k) // KEY for k in keys], np.int64).tobytes(),
               np.array([c for _, _, cs in held for c in cs], np.int64).tobytes(), b"".join(keys), before, after,
               keys[0] if number == 0 else None, keys[-1] if after is None else None)
        held, size, number, before = [], 0, number + 1, after
        return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, _CHUNK)], schema=_CHUNK)

    for b in batches:
        for row in zip(*(b.column(n).to_pylist() for n in ("conv_id", "seq", "chars"))):
            if held and (size + len(row[2]) > turns or len(held) >= rows):
                yield close(shared(_hashes(held[-1][1]), _hashes(row[1])))
            held.append(row)
            size += len(row[2])
    if held:
        yield close(None)


def sorted_chunks(seqs: DataFrame, turns: int = CHUNK_TURNS, rows: int = CHUNK_ROWS) -> DataFrame:
    """Chunks of all sequences in sorted order, each with what it shares with the rows ``before`` and ``after`` it (-1: there is none)."""
    # hashes end to end compare as the sequences do, and a sequence comes before those that go on from it
    packed = seqs.select("conv_id", F.unhex(F.expr("array_join(transform(turns, x -> hex(x.key)), '')")).alias("seq"),
                         F.expr("transform(turns, x -> x.chars)").alias("chars"))
    packed = materialize(packed, "trie-packed")
    cut = (packed.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
           .mapInArrow(lambda bs: _cut(bs, turns, rows), _CHUNK_DDL))
    cut = materialize(cut, "trie-chunks")
    # the numbers of the partitions that have rows: no more than the shuffle has partitions
    parts = sorted(r.part for r in cut.filter("first IS NOT NULL").select("part").collect())
    follows = cut.sparkSession.createDataFrame(list(zip(parts, parts[1:])), "part int, next int")
    ends = (cut.filter("last IS NOT NULL").select("part", "last").join(follows, "part")
            .join(cut.filter("first IS NOT NULL").select(F.col("part").alias("next"), "first"), "next"))

    def meet(batches):
        for b in batches:
            both = zip(b.column("last").to_pylist(), b.column("first").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("part"), b.column("next"), pa.array([shared(_hashes(x), _hashes(y)) for x, y in both], pa.int64())],
                                             names=["part", "next", "n"])

    met = materialize(ends.select("part", "next", "last", "first").mapInArrow(meet, "part int, next int, n long"), "trie-ends")
    # each partition's two ends: as many rows as there are partitions
    left = met.select(F.col("next").alias("part"), F.lit(0).alias("chunk"), F.col("n").alias("_before"))
    right = met.select("part", F.col("n").alias("_after"))
    joined = cut.join(left, ["part", "chunk"], "left").join(right, "part", "left")
    return joined.select("part", "chunk", "ids", "lengths", "chars", "keys", F.coalesce("before", "_before", F.lit(-1)).alias("before"),
                         F.coalesce("after", F.when(F.col("last").isNotNull(), F.col("_after")), F.lit(-1)).alias("after"))


# --- one chunk --------------------------------------------------------------

class RangeMinimum:
    """Sparse table: minima of every run of 2 ** k entries."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            v, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(v[:-step], v[step:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum of entries ``low .. high`` (both included)."""
        level = np.frexp(high - low + 1)[1] - 1
        out = np.empty(len(low), self.levels[0].dtype)
        for k in np.unique(level):
            of = level == k
            out[of] = np.minimum(self.levels[k][low[of]], self.levels[k][high[of] + 1 - (1 << int(k))])
        return out

    def reach_right(self, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The first entry from ``start`` on that is under ``bound``, or the number of entries."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            fits = np.flatnonzero(at + (1 << k) <= len(self.levels[0]))
            go = fits[self.levels[k][at[fits]] >= bound[fits]]
            at[go] += 1 << k
        return at

    def reach_left(self, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The last entry up to ``start`` that is under ``bound``, or -1."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            fits = np.flatnonzero(at - (1 << k) + 1 >= 0)
            go = fits[self.levels[k][at[fits] - (1 << k) + 1] >= bound[fits]]
            at[go] -= 1 << k
        return at


@dataclass
class Nodes:
    """A chunk's nodes: candidate prefixes that no row before it in the chunk has."""

    row: np.ndarray       # the first row of the chunk that holds it
    depth: np.ndarray
    parent: np.ndarray    # index of its parent, -1 for the root
    members: np.ndarray
    least: np.ndarray     # smallest member
    saved: np.ndarray
    children: np.ndarray  # that are new here
    leaves: np.ndarray
    new: np.ndarray       # no chunk before holds it
    open: np.ndarray      # a neighbouring chunk holds it too
    run: np.ndarray       # members that end here and follow its first row, that one included


class SortedChunk:
    """A run of the sorted conversations."""

    def __init__(self, ids: bytes, lengths: bytes, chars: bytes, keys: bytes, before: int, after: int):
        self.ids, self.length = np.frombuffer(ids, np.int64), np.frombuffer(lengths, np.int64)
        self.chars, self.keys = np.frombuffer(chars, np.int64), _hashes(keys)
        self.before, self.after = before, after
        self.at = np.concatenate([[0], np.cumsum(self.length)])

    def prefixes(self) -> np.ndarray:
        """L: turns shared with the row before, for every row and the one after the last."""
        n = len(self.ids)
        out = np.empty(n + 1, np.int64)
        out[0], out[n] = self.before, self.after
        for j in range(1, n):
            out[j] = shared(self.keys[self.at[j - 1]:self.at[j]], self.keys[self.at[j]:self.at[j + 1]])
        return out

    def nodes(self) -> Nodes:
        n, length, at = len(self.ids), self.length, self.at
        lcp = self.prefixes()
        inner = RangeMinimum(lcp[1:n])  # entry i lies between rows i and i + 1
        base = np.append(0, lcp[1:n] + 1)  # the first depth that is new in the row
        count = length + 1 - base
        start = np.concatenate([[0], np.cumsum(count)])
        row = np.repeat(np.arange(n), count)
        depth = np.arange(start[-1]) - start[row] + base[row]
        left = inner.reach_left(row - 1, depth) + 1
        right = inner.reach_right(row, depth)
        # a row's first candidate hangs from a node that an earlier row began
        parent = np.arange(start[-1]) - 1
        head = start[:-1][count > 0]
        top = row[head], depth[head] - 1
        begun = inner.reach_left(top[0] - 1, top[1]) + 1
        parent[head] = start[begun] + top[1] - base[begun]
        parent[0] = -1
        new = depth > lcp[row]
        new[:count[0]] = depth[:count[0]] > self.before
        own = new & (parent >= 0)
        children = np.bincount(parent[own], minlength=len(row)).astype(np.int64)

        run = np.zeros(n, np.int64)  # rows equal to row j, from j on
        same = np.append((lcp[1:n] == length[1:]) & (length[1:] == length[:-1]), False)
        edge = np.flatnonzero(~same)
        run = edge[np.searchsorted(edge, np.arange(n))] - np.arange(n) + 1

        characters = np.concatenate([[0], np.cumsum(self.chars)])
        total = characters[at[1:]] - characters[at[:-1]]
        seen = np.maximum(lcp[:n], 0)
        fresh = total - (characters[at[:-1] + np.minimum(seen, length)] - characters[at[:-1]])
        sums = lambda v: np.concatenate([[0], np.cumsum(v)])
        over = lambda s: s[right + 1] - s[left]
        members = right - left + 1
        above = characters[at[left] + np.maximum(depth - 1, 0)] - characters[at[left]]
        known = characters[at[left] + np.minimum(seen[left], length[left])] - characters[at[left]]
        held = over(sums(total)) - members * above
        distinct = over(sums(fresh)) - np.maximum(above - known, 0)
        leaf = (lcp[1:] < length) & (length > 0)
        low_id = RangeMinimum(self.ids).least(left, right)
        continues = ((left == 0) & (depth <= self.before)) | ((right == n - 1) & (depth <= self.after))
        return Nodes(row, depth, parent, members, low_id, held - distinct, children, over(sums(leaf)), new, continues,
                     np.where(depth == length[row], run[row], 0))

    def prefix_hashes(self, row: int, most: int) -> list[bytes]:
        """Hash of each of a row's prefixes of up to ``most`` turns."""
        digest, out = hashlib.blake2b(digest_size=KEY), []
        raw = self.keys[self.at[row]:self.at[row] + most].tobytes()
        for d in range(most + 1):
            out.append(digest.copy().digest())
            digest.update(raw[KEY * d:KEY * d + KEY])
        return out


def _chunks(batches: Iterator[pa.RecordBatch]):
    for b in batches:
        names = ["ids", "lengths", "chars", "keys", "before", "after"]
        for i in range(b.num_rows):
            yield b, i, SortedChunk(*(b.column(c)[i].as_py() for c in names))


_OPEN = ("part int, chunk int, node long, hash binary, members long, least long, saved long, children long, leaves long, ends binary")


def open_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's share of the nodes that reach over its ends."""
    names = [c.split()[0] for c in _OPEN.split(", ")]
    for b, i, chunk in _chunks(batches):
        nodes = chunk.nodes()
        which = np.flatnonzero(nodes.open)
        if not len(which):
            continue
        first = chunk.prefix_hashes(0, int(min(max(chunk.before, 0), chunk.length[0])))
        last = chunk.prefix_hashes(len(chunk.ids) - 1, int(min(max(chunk.after, 0), chunk.length[-1])))
        hashes = [first[d] if r == 0 and d < len(first) else last[d] for r, d in zip(nodes.row[which].tolist(), nodes.depth[which].tolist())]
        ends = [chunk.ids[r:r + k].tobytes() if k else None for r, k in zip(nodes.row[which].tolist(), nodes.run[which].tolist())]
        n = len(which)
        yield pa.RecordBatch.from_arrays(
            [pa.array([b.column("part")[i].as_py()] * n, pa.int32()), pa.array([b.column("chunk")[i].as_py()] * n, pa.int32()), pa.array(which),
             pa.array(hashes, pa.binary()), *(pa.array(getattr(nodes, c)[which].astype(np.int64)) for c in ("members", "least", "saved", "children", "leaves")),
             pa.array(ends, pa.binary())], names=names)


def _joined(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the ids of each open node's pieces, which stream by in order."""
    now, digest = None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], names=["hash", "ends_sha256"])

    for b in batches:
        for i in range(b.num_rows):
            key, ids = b.column("hash")[i].as_py(), np.frombuffer(b.column("ends")[i].as_py(), np.int64)
            if key != now:
                if now is not None:
                    yield row()
                now, digest = key, hashlib.sha256(_joined(ids))
            else:
                digest.update(b"," + _joined(ids))
    if now is not None:
        yield row()


_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
_BACK = ("node", "members", "least", "saved", "children", "leaves", "ends_sha256")


def whole_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the nodes that begin in each chunk; open ones with the sums that came back."""
    names = [c.split()[0] for c in _NODE.split(", ")]
    for b, i, chunk in _chunks(batches):
        nodes = chunk.nodes()
        sha = np.full(len(nodes.row), EMPTY_SHA256, object)
        for k in np.flatnonzero((nodes.run > 0) & ~nodes.open).tolist():
            r = nodes.row[k]
            sha[k] = hashlib.sha256(_joined(chunk.ids[r:r + nodes.run[k]])).hexdigest()
        back = b.column("back")[i].as_py() or []
        if back:
            at = np.array([x["node"] for x in back], np.int64)
            for c in ("members", "least", "saved", "children", "leaves"):
                getattr(nodes, c)[at] = [x[c] for x in back]
            sha[at] = [x["ends_sha256"] or EMPTY_SHA256 for x in back]
        leaves = np.where(nodes.children == 0, 1, nodes.leaves)  # the root of turnless conversations alone
        up = np.where(nodes.parent >= 0, nodes.least[np.maximum(nodes.parent, 0)], 0)
        cols = [nodes.least, nodes.depth, up, nodes.members, nodes.children, leaves, nodes.saved]
        keep = np.flatnonzero(nodes.new)
        for s in range(0, len(keep), 20_000):
            k = keep[s:s + 20_000]
            arrays = [pa.array(c[k], pa.int64(), mask=nodes.parent[k] < 0 if j == 2 else None) for j, c in enumerate(cols)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(sha[k].tolist(), pa.string())], names=names)


def trie(seqs: DataFrame, turns: int = CHUNK_TURNS, rows: int = CHUNK_ROWS) -> DataFrame:
    """Every node of the prefix trie of ``(conv_id, turns)``."""
    cut = materialize(sorted_chunks(seqs, turns, rows), "trie-sorted")
    parts = materialize(cut.mapInArrow(open_parts, _OPEN), "trie-open")
    whole = parts.groupBy("hash").agg(*(F.sum(c).alias(c) for c in ("members", "saved", "children", "leaves")), F.min("least").alias("least"))
    ends = (parts.filter("ends IS NOT NULL").select("hash", "part", "chunk", "ends").repartition("hash")
            .sortWithinPartitions("hash", "part", "chunk").mapInArrow(_ends, "hash binary, ends_sha256 string"))
    back = (parts.select("part", "chunk", "node", "hash").join(whole.join(ends, "hash", "left"), "hash")
            .groupBy("part", "chunk").agg(F.collect_list(F.struct(*_BACK)).alias("back")))
    return cut.join(back, ["part", "chunk"], "left").mapInArrow(whole_nodes, _NODE)


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """Prefix trie of all rebuilt ``conversations``."""
    from corpuscheck.llm.tables import read

    return trie(rebuilt(sequences(read(spark, sf_dir, "conversations"))))


def _sql() -> str:
    # the reflected CRC-32, a byte at a time
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
    crc = ("xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), "
           f"lambda c, b: {bits}), 4294967295)")
    return f"""
WITH t AS MATERIALIZED (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos,
    strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS said, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL),
c AS MATERIALIZED (SELECT conv_id, conv_id - conv_id % {LEAD_GROUP} AS lead, {crc} % {LEAD_TURNS} AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
r AS MATERIALIZED (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS pos, said, chars FROM (
  SELECT c.conv_id, 0 AS own, t.pos, t.said, t.chars FROM c JOIN t ON t.conv_id = c.lead AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.said, t.chars FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h)),
s AS MATERIALIZED (SELECT c.conv_id, coalesce(list(said ORDER BY pos) FILTER (pos IS NOT NULL), []) AS seq,
  coalesce(list(chars ORDER BY pos) FILTER (pos IS NOT NULL), []) AS chars FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
m AS MATERIALIZED (SELECT conv_id, d, seq[1:d] AS prefix, len(seq) = d AS ended, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars
  FROM (SELECT conv_id, seq, chars, unnest(range(len(seq) + 1)) AS d FROM s)),
n AS MATERIALIZED (SELECT row_number() OVER () AS id, prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256 FROM m GROUP BY prefix, d),
mine AS MATERIALIZED (SELECT m.conv_id, m.d, n.id FROM m JOIN n ON n.d = m.d AND n.prefix = m.prefix),
up AS MATERIALIZED (SELECT DISTINCT a.id, b.id AS parent FROM mine a JOIN mine b ON b.conv_id = a.conv_id AND b.d = a.d - 1),
kids AS MATERIALIZED (SELECT parent AS id, count(*) AS n FROM up GROUP BY parent),
under AS (SELECT DISTINCT a.id, b.id AS below FROM mine a JOIN mine b ON b.conv_id = a.conv_id AND b.d >= a.d),
sums AS (SELECT under.id, count(*) FILTER (kids.n IS NULL) AS n_leaves, sum((x.n_convs - 1) * x.chars) AS saved_tokens
  FROM under JOIN n x ON x.id = under.below LEFT JOIN kids ON kids.id = under.below GROUP BY under.id)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children, sums.n_leaves,
  CAST(sums.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN sums USING (id) LEFT JOIN kids USING (id) LEFT JOIN up USING (id) LEFT JOIN n p ON p.id = up.parent
"""


SQL = _sql()
