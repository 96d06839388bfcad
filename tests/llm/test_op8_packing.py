import random
import zlib

import numpy as np
import pytest

from corpuscheck.llm import op8_packing as P

from .texts import SCHEMA, corpus, frame

TEXTS = ["don't <|endoftext|> stop", "a  b   c", " x", "x ", "né à été ñ", "tab\tnew\n\n line\r\n", "a b　c  d", "日本 語 テスト",
         "1 22 333 !! ## a1b2", "\x00 \x01", "é é", "\n \n a", "a <|endoftext|> b<|endoftext|>"]


def _ids():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.tokenizer_path())
    return lambda text: np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def test_pieces_equal_the_tokenizer(spark, monkeypatch):
    monkeypatch.setattr(P, "CACHE_PARTS", 500)
    docs = corpus() + [(5000 + k, t) for k, t in enumerate(TEXTS)]
    ids = _ids()
    want = []
    for i, t in docs:
        x, cap = ids(t), 256
        k = -(-len(x) // cap)
        lead = len(x) - (k - 1) * cap
        cuts = [0, *range(lead, len(x) + 1, cap)]
        want += [(i, n, a, b - a, zlib.crc32(x[a:b].tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got = [tuple(r) for r in P.pieces(frame(spark, docs), P.tokenizer_path(), 256).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def _valid(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("partition", [40, 50_000])
def test_packing_is_gapless_and_near_the_bound(spark, partition):
    rng = random.Random(partition)
    sizes = [rng.choice([2048, 1500, 700, 300, 100, 30, rng.randrange(1, 2049)]) for _ in range(900)]
    rows = spark.createDataFrame([(i, 0, 0, s, i) for i, s in enumerate(sizes)], P._PIECES)
    got = P.pack(rows, partition_pieces=partition).collect()
    assert sorted((r.doc_id, r.length) for r in got) == sorted(enumerate(sizes))
    bound = P.lower_bound(np.bincount(sizes, minlength=2049))
    assert bound <= _valid(got, 2048) <= bound * (1.01 if partition > 40 else 1.05)


def test_bound_never_exceeds_a_packing():
    rng = np.random.default_rng(7)
    for _ in range(200):
        cap = int(rng.integers(4, 60))
        sizes = rng.integers(1, cap + 1, int(rng.integers(1, 40)))
        seq, offset, fill = P.best_fit_decreasing(sizes, cap)
        assert fill.max() <= cap and fill.sum() == sizes.sum() and len(fill) == seq.max() + 1
        assert P.lower_bound(np.bincount(sizes, minlength=cap + 1), cap) <= len(fill)
    # sizes over half can't share
    assert P.lower_bound(np.bincount([60] * 5, minlength=101), 100) == 5


def test_repeated_rows_nulls_and_empty_table(spark):
    rows = P.pack_documents(frame(spark, [(1, "a b"), (1, "a b"), (None, None), (3, "")])).collect()
    assert sorted(((r.doc_id, r.length) for r in rows), key=str) == sorted([(1, 3), (1, 3), (None, 1), (3, 1)], key=str)
    assert _valid(rows, 2048) == 1
    empty = P.pack_documents(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[-2:] == ["sequence_id", "offset"]
