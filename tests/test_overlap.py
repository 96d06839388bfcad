"""Jaccard by groups against brute force: cut groups, ids that repeat, two sides, few copies of a text."""

from __future__ import annotations

import random

import pytest

from corpuscheck.operators import overlap as O
from corpuscheck.operators import similarity as S


def _sets(rows):
    out = []
    for i, text in rows:
        w = text.split()
        out.append((i, text, {tuple(w[k:k + 2]) for k in range(len(w) - 1)}))
    return out


def _frame(spark, rows):
    return S.gram_sets(spark.createDataFrame(rows, "file_id long, text string"), 2, persist=False)


def _corpus(seed, n):
    rnd = random.Random(seed)
    base = [f"u{k}" for k in range(30)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rnd.randrange(12)):
            w[rnd.randrange(30)] = f"v{rnd.randrange(50)}"
        rows.append((i, " ".join(w)))
    return rows + [(n, ""), (n + 1, "u1"), (n + 2, rows[0][1]), (3, "u5 u6 u7 u8 u9 x")]


@pytest.mark.parametrize("side_bytes", [O.SIDE_BYTES, 500, 1])
def test_equals_brute_force(spark, side_bytes, monkeypatch):
    monkeypatch.setattr(O, "CHUNK_BYTES", 700)
    rows, probes = _corpus(1, 40), _corpus(2, 25)
    for left, right, one in ((rows, rows, True), (rows, probes, False)):
        a, b = _sets(left), _sets(right)
        pairs = sorted({(x, y) for x, _, _ in a for y, _, _ in b if (x < y or not one) and (x + y) % 3})
        want = []
        for p in pairs:
            found = [(*p, len(ga & gb) / len(ga | gb), ta != tb) for x, ta, ga in a for y, tb, gb in b if (x, y) == p and ga | gb]
            found = [f for f in found if f[2] >= 0.4]
            # rows that share an id: each pair of theirs as often as there are links of different texts
            want += sorted(f[:3] for f in found) * sum(f[3] for f in found)
        want.sort()
        gs_a = _frame(spark, left)
        got = O.grouped_jaccard(spark.createDataFrame(pairs, "a long, b long"), gs_a, gs_a if one else _frame(spark, right), 0.4, side_bytes)
        assert sorted(tuple(r) for r in got.collect()) == want and want


def test_a_family_is_sent_once_and_not_for_each_pair(spark, monkeypatch):
    rows = _corpus(3, 120)[:120]
    gs = _frame(spark, rows)
    pairs = spark.createDataFrame([(x, y) for x in range(120) for y in range(x + 1, 120)], "a long, b long")
    sent = []
    monkeypatch.setattr(type(pairs), "mapInArrow", lambda df, f, schema: sent.append(df.count()) or df)
    O.grouped_jaccard(pairs, gs, gs, 0.4)
    # 7,140 pairs; every text takes part at most once on either side
    assert sent == [2 * 119]


def test_row_jaccard_keeps_columns_and_empty_unions(spark):
    rows = _corpus(4, 20)
    sets = {i: g for i, _, g in _sets(rows[:-1])}
    ids = sorted(sets)
    gs = _frame(spark, rows[:-1])
    pairs = spark.createDataFrame([(x, y, f"{x}-{y}") for x in ids for y in ids], "a long, b long, note string")
    got = S.pair_jaccard(pairs, gs)
    assert set(got.columns) == {"a", "b", "note", "jaccard"}
    want = {(x, y, f"{x}-{y}"): len(sets[x] & sets[y]) / max(len(sets[x] | sets[y]), 1) for x in ids for y in ids}
    assert {(r.a, r.b, r.note): r.jaccard for r in got.collect()} == want
