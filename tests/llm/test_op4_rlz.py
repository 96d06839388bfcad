import hashlib

from corpuscheck.llm import op4_rlz as Z

from .texts import SCHEMA, WORD, corpus, frame, unique_ids


def _brute(docs, block=20):
    seen, out = set(), {}
    for i, t in docs:
        w = WORD.findall(t or "")
        gone = set()
        for k in range(len(w) - block + 1):
            key = tuple(w[k:k + block])
            if key in seen:
                gone.update(range(k, k + block))
            seen.add(key)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


def test_equals_brute_force(spark):
    docs = unique_ids(corpus())
    got = {r.doc_id: tuple(r)[1:] for r in Z.remove_duplicates(frame(spark, docs), texts=True).collect()}
    want = _brute(docs)
    assert {i: v[:3] + v[4:] for i, v in got.items()} == want
    assert sum(v[1] > 0 for v in want.values()) > 20


def test_many_small_partitions_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(Z.blobs, "BYTES_PER_PARTITION", 2000)
    monkeypatch.setattr(Z.blobs, "text_partitions", lambda docs: 7)
    docs = unique_ids(corpus(seed=9, n=30))
    for block in (5, 20):
        got = {r.doc_id: tuple(r)[1:4] for r in Z.remove_duplicates(frame(spark, docs).repartition(5), block).collect()}
        assert got == {k: v[:3] for k, v in _brute(docs, block).items()}


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = " ".join(f"t{i}" for i in range(50))
    got = sorted((r.doc_id or -1, r.n_removed) for r in Z.remove_duplicates(frame(spark, [(1, text), (1, text), (2, text), (None, "a b")])).collect())
    assert got == [(-1, 0), (1, 0), (1, 0), (2, 50)]
    got = {r.doc_id: r.n_removed for r in Z.remove_duplicates(frame(spark, [(1, text), (None, text)])).collect()}
    assert got == {None: 0, 1: 50}
    assert Z.remove_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def _check_factors(docs, found, block):
    """Every factor is a copy of earlier words; those of a document don't overlap and none could go on from its source."""
    words = {i: WORD.findall(t or "") for i, t in docs}
    places = {}
    for i in sorted(words):
        for k in range(len(words[i]) - block + 1):
            places.setdefault(tuple(words[i][k:k + block]), (i, k))
    behind = {}
    for f in sorted(found):
        i, start, n, source, at = f
        assert n >= block and words[i][start:start + n] == words[source][at:at + n] and len(words[i]) >= start + n
        assert (source, at) < (i, start) and start >= behind.get(i, 0)
        # what the parse passed over are literals: their blocks have no source
        for k in range(behind.get(i, 0), start):
            assert places[tuple(words[i][k:k + block])] == (i, k)
        behind[i] = start + n
    return behind


def test_factors_are_copies_of_earlier_words(spark):
    docs = unique_ids(corpus())
    found = [tuple(r) for r in Z.factors(frame(spark, docs).repartition(3)).collect()]
    behind = _check_factors(docs, found, 20)
    assert len(found) > 20 and len(behind) < len(found)
    counts = {r.doc_id: r.n_factors for r in Z.remove_duplicates(frame(spark, docs)).collect()}
    assert {i for i, n in counts.items() if n} == set(behind)


def test_factors_of_two_sources_and_the_boundary_between(spark):
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    docs = [(1, " ".join(a)), (2, " ".join(["x"] * 5 + b)), (3, " ".join(a + b)),
            # ten words behind a factor stand under blocks that begin inside it
            (4, " ".join(a[50:] + [f"c{i}" for i in range(10)])), (5, " ".join(a + [f"c{i}" for i in range(10)] + ["y"] * 3))]
    got = sorted(tuple(r) for r in Z.factors(frame(spark, docs)).collect())
    assert got == [(3, 0, 60, 1, 0), (3, 60, 60, 2, 5), (5, 0, 60, 1, 0)]
    _check_factors(docs, got, 20)
    gone = {r.doc_id: (r.n_words, r.n_removed, r.n_factors) for r in Z.remove_duplicates(frame(spark, docs)).collect()}
    assert gone == {1: (60, 0, 0), 2: (65, 0, 0), 3: (120, 120, 2), 4: (20, 0, 0), 5: (73, 70, 1)}


def test_factors_of_repeated_rows_and_null_ids(spark):
    text = " ".join(f"t{i}" for i in range(50))
    other = " ".join(f"t{i}" for i in range(20, 50))
    got = sorted(tuple(r) for r in Z.factors(frame(spark, [(7, text), (7, text), (7, other), (None, text), (9, other)])).collect())
    # equal starts under one id are not earlier than each other; the NULL id is before all
    assert got == [(7, 0, 30, None, 20), (7, 0, 50, None, 0), (9, 0, 30, None, 20)]
    assert Z.factors(spark.createDataFrame([], SCHEMA)).count() == 0
