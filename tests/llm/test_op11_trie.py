import hashlib
import os
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from corpuscheck.llm import op11_trie as O

SCHEMA = ("conv_id long, turn long, role string, text string, key string, turns string, part string, chunk string, ids string, "
          "hash string, node string, depth string, first string, last string, chars string, t string")
N_EXTRA = 12


def _rebuilt(table):
    """Sequences of (role, text) as the contract words it."""
    held = defaultdict(list)
    for c, turn, role, text in table:
        if c is not None:
            role, text = role or "", text or ""
            held[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest(), (role, text)))
    held = {c: [x[-1] for x in sorted(v)] for c, v in held.items()}
    out = {}
    for c, own in held.items():
        h = zlib.crc32(str(c).encode()) % 6
        lead = c - (c % 100 if c >= 0 else -((-c) % 100))
        out[c] = held.get(lead, [])[:h] + own[h:]
    return out


def _brute(seqs):
    members, kids = defaultdict(list), defaultdict(set)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
            if d:
                kids[tuple(s[:d - 1])].add(tuple(s[:d]))
    out = []
    for p, ids in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = sorted(c for c in ids if len(seqs[c]) == len(p))
        out.append((min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), len(kids[p]), sum(not kids[q] for q in below),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def _table(seed, n=260):
    rng, out = random.Random(seed), []
    for c in [*range(n), -130, -100, -1, 5000]:
        first = rng.choice(["hello", "hello", "hi", None, "é" * 3])
        for turn in range(rng.randrange(1, 9)):
            text = first if turn == 0 else rng.choice(["a", "b", "", None, "more"])
            out.append((c, turn if rng.random() < 0.97 else None, rng.choice(["user", "user", None, "assistant"]) if turn % 2 else "user", text))
    for c in range(n, n + 40):  # copies
        out += [(c, k, "user", t) for k, t in enumerate(["hello", "a", "b", "same", "same", "same", "end"])]
    out += [(700, k, "user", f"long {k}") for k in range(300)] + [(799, k, "user", f"long {k}") for k in range(299)] + [(799, 400, "user", "other")]
    out += [(900, 0, "user", "x" * 60_000), (901, 0, "u", "ser"), (902, 0, "us", "er"), (903, 1, "a", "a"), (903, 1, "a", "a"), (903, 1, "b", "a")]
    out += [(None, 0, "user", "hello"), (None, None, None, None)]
    rng.shuffle(out)
    return out


def _frame(spark, table):
    return spark.createDataFrame([(*r, *"x" * N_EXTRA) for r in table], SCHEMA)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("turns, rows", [(O.CHUNK_TURNS, O.CHUNK_ROWS), (40, 7), (1, 1)])
def test_against_brute_force(spark, turns, rows):
    """NULLs in every column, ties, repeated rows, copies, turnless and long conversations, clashing columns; at any size of chunks."""
    table = _table(3)
    got = _rows(O.trie(O.rebuilt(O.sequences(_frame(spark, table))), turns, rows))
    assert got == _brute(_rebuilt(table))


def test_turnless_conversations(spark):
    """A lead of none and fewer own turns than it leaves nothing: members of the root alone."""
    c = [c for c in range(101, 4000) if zlib.crc32(str(c).encode()) % 6 >= 2 and c % 100][:9]
    alone = [(x, 0, "user", "a") for x in c]
    for table in (alone, alone + [(7, k, "user", "b") for k in range(9)]):
        assert _rows(O.trie(O.rebuilt(O.sequences(_frame(spark, table))), 10, 2)) == _brute(_rebuilt(table))


def test_many_copies_over_many_chunks(spark):
    """One conversation that nearly all share lies in many chunks and partitions, its ends hashed in order."""
    table = [(c, k, "user", f"t{k}") for c in range(1, 3001) for k in range(7)] + [(c, 0, "user", "own") for c in range(4000, 4100)]
    got = _rows(O.trie(O.sequences(_frame(spark, table)), 100, 50))
    seqs = defaultdict(list)
    for c, _, role, text in table:
        seqs[c].append((role, text))
    assert got == _brute(seqs)


def test_range_minimum():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 17, 64, 65):
        v = rng.integers(0, 6, n)
        table = O.RangeMinimum(v)
        for at in range(n):
            for bound in range(7):
                right = next((i for i in range(at, n) if v[i] < bound), n)
                left = next((i for i in range(at, -1, -1) if v[i] < bound), -1)
                one = np.array([at]), np.array([bound])
                assert table.reach_right(*one)[0] == right and table.reach_left(*one)[0] == left
            for high in range(at, n):
                assert table.least(np.array([at]), np.array([high]))[0] == v[at:high + 1].min()


def test_empty_table(spark):
    assert O.trie(O.rebuilt(O.sequences(spark.createDataFrame([], SCHEMA)))).collect() == []


def test_query_equals_sql_and_brute_force(spark, tmp_path):
    con = duckdb.connect()
    small = [r for r in _table(8, 150) if r[0] is None or r[0] not in (700, 799)]
    spark.createDataFrame(small, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    for path in (str(tmp_path), "/root/testdata/sf0.001"):
        files = f"{path}/conversations.parquet" + ("/*.parquet" if os.path.isdir(f"{path}/conversations.parquet") else "")
        con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{files}'")
        got = _rows(O.op11_prefix_trie(spark, path))
        table = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
        assert got == sorted(con.execute(O.SQL).fetchall(), key=str) == _brute(_rebuilt(table))
