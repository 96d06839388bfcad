import random

import numpy as np
import pyarrow as pa

from corpuscheck.llm import op10_decontamination as D
from corpuscheck.llm.words import text_buffers

from .texts import SCHEMA, WORD, corpus, frame, words

MARKS = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())


def _words(t):
    out = []
    for w in WORD.findall(t or ""):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w).strip(MARKS)
        if w:
            out.append(w)
    return out


def _inside(p, t):
    """Fewest edits of ``p`` anywhere in ``t``."""
    col = list(range(len(p) + 1))
    best = col[-1]
    for w in t:
        new = [0]
        for i, x in enumerate(p, 1):
            new.append(min(col[i] + 1, new[i - 1] + 1, col[i - 1] + (x != w)))
        col, best = new, min(best, new[-1])
    return best


def test_bit_parallel_distance():
    rng = random.Random(1)
    for _ in range(300):
        p, t = ([rng.randrange(5) for _ in range(n)] for n in (rng.randrange(1, 90), rng.randrange(0, 120)))
        mask = {}
        for i, x in enumerate(p):
            mask[x] = mask.get(x, 0) | 1 << i
        assert min(D.myers(mask, len(p), t, len(p))[0], len(p)) == _inside(p, t)


def test_word_codes():
    texts = [t for _, t in corpus()] + ["(Hello), -- 'World'! a.b ... x"]
    data, bounds = text_buffers(pa.array(texts, pa.string()))
    h, first = D.word_codes(data, bounds)
    assert np.diff(first).tolist() == [len(_words(t)) for t in texts]
    flat = sum(map(_words, texts), [])
    assert len(set(h.tolist())) == len(set(flat)) and len(set(zip(h.tolist(), flat))) == len(set(flat))


def _case(spark):
    rng = random.Random(4)
    items = [(k, " ".join(words(rng, rng.randrange(2, 60), 300))) for k in range(30)] + [(30, None), (31, " .. "), (32, "Alpha beta"), (33, "alpha, BETA")]
    docs = corpus(n=20)
    at = 10_000
    for k, t in items[:30]:
        w = t.split()
        for edits in (0, 1, 2, D.budget(len(w)), D.budget(len(w)) + 3):
            x = list(w)
            for _ in range(edits):
                x[rng.randrange(len(x))] = f"edit{rng.randrange(99)}"
                if rng.random() < 0.3:
                    x.insert(rng.randrange(len(x)), "more")
                if rng.random() < 0.3 and len(x) > 1:
                    del x[rng.randrange(len(x))]
            docs.append((at, " ".join(words(rng, rng.randrange(0, 50), 300) + [y.title() + "," for y in x] + words(rng, 20, 300))))
            at += 1
    docs.append((at, "so alpha -- beta it is"))
    return docs, items


def test_matches_equal_brute_force(spark, monkeypatch):
    docs, items = _case(spark)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for i, t in docs:
        for k, item in items:
            p = _words(item)
            e = _inside(p, _words(t)) if p else 99
            if p and e <= D.budget(len(p)):
                want.add((i, k, e))
    got = [(r.doc_id, r.item_id, r.edits) for r in D.matches(frame(spark, docs), bench).collect()]
    assert set(got) == want and len(want) > 80
    flags = {(r.doc_id, r.contaminated) for r in D.contamination(frame(spark, docs), bench).collect()}
    assert {i for i, c in flags if c} == {i for i, _, _ in want}
    monkeypatch.setattr(D, "BLOCK_ITEMS", 7)
    assert {(r.doc_id, r.contaminated) for r in D.contamination(frame(spark, docs), bench).collect()} == flags
    clean = D.keep_documents(frame(spark, docs), bench)
    assert sorted(r.doc_id or -1 for r in clean.collect()) == sorted(i or -1 for i, t in docs if i not in {w[0] for w in want} or i is None)
    assert clean.columns == frame(spark, docs).columns


def test_empty_tables(spark):
    docs, items = _case(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in D.contamination(frame(spark, docs), none).collect())
    assert D.matches(frame(spark, docs), none).count() == 0
    assert D.keep_documents(frame(spark, docs), none).count() == len(docs)
    assert D.contamination(spark.createDataFrame([], SCHEMA), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_a_row_stays_a_row_under_several_blocks(spark, monkeypatch):
    docs, items = _case(spark)
    hit, other = next(t for i, t in docs if i == 10_000), next(t for i, t in docs if i == 10_005)
    docs = docs + [(None, hit), (None, "clean"), (None, None), (None, other), (7_000, hit), (7_000, other), (7_000, "clean"), (7_000, hit)]
    # equal words under a smaller id, under no id, and in another block
    items = items + [(-5, items[0][1]), (None, items[0][1]), (60, "alpha beta"), (60, items[1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = lambda: sorted(map(str, D.contamination(frame(spark, docs), bench).collect()))
    one = rows()
    assert len(one) == len(docs) and len(set(one)) < len(docs)
    for most in (1, 7):
        monkeypatch.setattr(D, "BLOCK_ITEMS", most)
        assert rows() == one
    empty = D.contamination(spark.createDataFrame([], SCHEMA), bench)
    assert empty.count() == 0 and empty.columns == ["doc_id", "contaminated", "n_items", "best_item", "edits"]
    found = [(r.doc_id, r.contaminated, r.n_items, r.best_item, r.edits) for r in D.contamination(frame(spark, docs), bench).collect()]
    assert sorted(f[1] for f in found if f[0] == 7_000) == [False, True, True, True]
    assert all(f[3] == -5 for f in found if f[0] == 10_000)
