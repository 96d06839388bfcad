import random

import numpy as np
import pyarrow as pa

from corpuscheck.llm import blobs
from corpuscheck.llm.words import chunks, hash_spans, roll, split_words, text_buffers, windows

from .texts import WORD, corpus


def test_words_and_hashes_of_a_chunk():
    texts = [t for _, t in corpus()]
    data, bounds = text_buffers(pa.array(texts, pa.string()))
    s, e, first = split_words(data, bounds)
    got = [bytes(data[i:j]).decode() for i, j in zip(s, e)]
    want = [WORD.findall(t or "") for t in texts]
    assert got == sum(want, [])
    assert np.diff(first).tolist() == [len(w) for w in want]
    h = hash_spans(data, s, e)
    assert len(set(h.tolist())) == len(set(got))
    low = hash_spans(data, s, e, lower=True)
    assert len(set(low.tolist())) == len({"".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in got})
    at, d = windows(first, 3)
    flat = sum(([tuple(w[i:i + 3]) for i in range(len(w) - 2)] for w in want), [])
    assert len(at) == len(flat) and len(set(roll(h, 3)[at].tolist())) == len(set(flat))


def test_hashes_do_not_depend_on_the_block(monkeypatch):
    from corpuscheck.llm import words

    text = " ".join(f"word{i}" for i in range(5000)) + " " + "x" * 5000
    data, bounds = text_buffers(pa.array([text, "word1"]))
    spans = split_words(data, bounds)[:2]
    whole = hash_spans(data, *spans)
    monkeypatch.setattr(words, "_BLOCK", 64)
    assert (hash_spans(data, *spans) == whole).all()
    assert whole[1] == whole[-1]


def test_chunks_keep_rows_and_bound_bytes():
    rng = random.Random(2)
    rows = [(i, None if i % 9 == 0 else "x" * rng.randrange(0, 300)) for i in range(500)]
    batches = [pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows[i:i + 77]], "text": pa.array([r[1] for r in rows[i:i + 77]], pa.string())})
               for i in range(0, 500, 77)]
    got = list(chunks(iter(batches), max_bytes=1000, max_docs=50))
    assert [i for c in got for i in c.column("doc_id")] == list(range(500))
    assert [c.text(k).decode() for c in got for k in range(len(c))] == [r[1] or "" for r in rows]
    assert all(len(c) <= 50 and (len(c.data) <= 1000 or len(c) == 1) for c in got)
    assert list(chunks(iter([]))) == []


def test_packing_round_trip():
    a = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64))
    got = blobs.unpack(blobs.pack(*blobs.shrink(a), np.array([True, False]), np.zeros(0, np.uint16)))
    assert (blobs.grow(got[0], got[1]) == a).all() and got[2].tolist() == [True, False] and len(got[3]) == 0
    assert len(blobs.grow(*blobs.shrink(a[:0]))) == 0
