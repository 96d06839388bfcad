"""Stored state: bucketed postings, classes in place of pairs, committed segments, merging."""

from __future__ import annotations

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from corpuscheck.operators import postings as P
from corpuscheck.operators import similarity as S
from corpuscheck.plans import report as RP
from corpuscheck.session import scratch_path
from corpuscheck.streaming import state as SS
from corpuscheck.streaming import stream as ST

UPLOADS = "upload_id long, name string, text string"


def _texts(seed, n, words=12):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        if i > 3 and rnd.random() < 0.4:
            w = rnd.choice(out).split()
            if rnd.random() < 0.7:
                w[rnd.randrange(len(w))] = f"x{i}"
            out.append(" ".join(w) + rnd.choice(["", "!"]))
        else:
            out.append(" ".join(f"v{rnd.randrange(60)}" for _ in range(words)))
    return out


def _gram_sets(spark, texts, first=0):
    return S.gram_sets(spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], "file_id long, text string"), 2)


def _pairs(df):
    return sorted((r.probe, r.doc, r.exact, round(r.jaccard, 9)) for r in df.collect())


def _plan_lines(df):
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def test_postings_are_joined_without_an_exchange(spark, monkeypatch):
    """Neither an Exchange nor a Generate lies over the stored rows before they are joined."""
    corpus = _gram_sets(spark, _texts(1, 80))
    stored = RP.store_corpus(corpus)
    plans, write = {}, S.materialize

    def spy(df, name):
        plans[name] = _plan_lines(df)
        return write(df, name)

    monkeypatch.setattr(S, "materialize", spy)
    got = _pairs(S.cross_similar(_gram_sets(spark, _texts(1, 80)[30:] + _texts(2, 20), 500), stored.grams, 0.3, True, stored.postings, stored.members))
    assert len(got) > 50
    for name in ("probe_prefix", "candidates"):
        assert _until_joined(plans[name]) == 1


def _until_joined(lines):
    """Number of bucketed scans of a plan; neither an exchange nor an explode may lie between them and their join."""
    depth = lambda x: len(re.match(r"[\s:+\-|]*", x).group())
    scans = [i for i, x in enumerate(lines) if "Bucketed: true" in x]
    for at in scans:
        above, level = [], depth(lines[at])
        for x in reversed(lines[:at]):
            if depth(x) < level:
                level = depth(x)
                above.append(x.strip(" :+-"))
        join = next(i for i, x in enumerate(above) if "Join" in x)
        assert not [x for x in above[:join] if "Exchange" in x or "Generate" in x], above
    return len(scans)


def test_a_batch_looks_hashes_up_in_every_segment_without_an_exchange(spark):
    """First ids by content hash, over segments and in another session's tables; the catalogue isn't read."""
    from corpuscheck.operators import ingest as I

    root = os.path.join(scratch_path(spark, "segments"), "state")
    ST.process_batch(_uploads(spark, ["one two three", "four five six"]), 0, root)
    ST.process_batch(_uploads(spark, ["four five six", "seven eight nine"], 10), 1, root)
    state = SS.latest(spark, root)
    assert len(state.segments) == 2
    batch = I.prepare_uploads(_uploads(spark, ["seven eight nine", "one two three", "new", "new"], 20))
    new, mapping = I.incremental_ingest(state.known("hashes", batch), batch, with_text=False)
    lines = _plan_lines(mapping)
    assert _until_joined(lines) == 2 and not [x for x in lines if "/catalog" in x]
    assert sorted(map(tuple, mapping.collect())) == [(20, 11, True), (21, 0, True), (22, 22, False), (23, 22, False)]
    assert [r.file_id for r in new.collect()] == [22]
    assert sorted(map(tuple, ST.read_state(spark, root, "mapping").collect())) == [(0, 0, False), (1, 1, False), (10, 1, True), (11, 11, False)]


def test_postings_read_back_and_hot_tokens_in_slots(spark):
    """A token that all documents hold lies in many buckets, and pairs are the same."""
    texts = ["common words here " + t for t in _texts(3, 60)]
    corpus, probes = _gram_sets(spark, texts), _gram_sets(spark, texts[20:] + _texts(4, 10), 900)
    members = S.class_members(corpus)
    tokens = S.token_postings(S.representatives(corpus, members))
    base = scratch_path(spark, "hot-test")
    written = P.write_postings(tokens, corpus.count(), f"{base}/rows", f"{base}/hot", 8, hot_rows=5)
    again = P.read_postings(spark, f"{base}/rows", f"{base}/hot", 8)
    assert written.rows().count() == tokens.count() == again.rows().count()
    most = again.rows().groupBy("h").agg(F.countDistinct("slot").alias("n")).agg(F.max("n")).first()[0]
    assert most > 5
    want = _pairs(S.cross_similar(probes, corpus, 0.3))
    assert _pairs(S.cross_similar(probes, corpus, 0.3, True, again, members)) == want and len(want) > 60


def test_gram_sets_write_less_than_twice_the_text(spark):
    texts = [" ".join(f"word{random.Random(i * 1000 + k).randrange(5000)}" for k in range(400)) for i in range(60)]
    gs = _gram_sets(spark, texts)
    size = sum(os.path.getsize(f.split(":", 1)[1].replace("//", "")) for f in gs.inputFiles())
    assert size <= 2 * sum(map(len, texts))


def test_a_group_of_ten_thousand_copies_is_stored_in_as_many_rows(spark):
    docs = spark.range(10_000).select(F.col("id").alias("file_id"), F.lit("one text that everybody copied word for word").alias("text"))
    near = spark.createDataFrame([(20_000, "one text that everybody copied word for line"), (20_001, "something else entirely is here")], docs.schema)
    members, links = S.similar_classes(S.gram_sets(docs.unionByName(near), 3), 0.3)
    assert members.count() == 10_002 and links.count() == 1
    flags = S.similar_flags(members, links)
    assert flags.filter("is_plagiarism").count() == 10_000 and not flags.filter("id = 20001").first().is_plagiarism
    asked = spark.createDataFrame([(3,), (20_000,), (0,)], "file_id long")
    got = S.earlier_similar(members, links, asked)
    assert {r.file_id: r.n for r in got.groupBy("file_id").agg(F.count("*").alias("n")).collect()} == {3: 3, 20_000: 10_000}


def test_own_collisions_keep_a_pair(spark, monkeypatch):
    """Two grams of one document with one code: the bound still holds, strings decide."""
    real = F.xxhash64

    def weak(*cols):
        return F.pmod(real(*cols), F.lit(40)).cast("long")

    texts = _texts(5, 40)
    want = sorted((r.a, r.b, r.exact, round(r.jaccard, 9)) for r in S.similar_pairs(_gram_sets(spark, texts), 0.3).collect())
    monkeypatch.setattr(S.F, "xxhash64", weak)
    gs = _gram_sets(spark, texts)
    assert gs.filter(F.size("tokens") < F.col("n_grams")).count() > 5
    got = sorted((r.a, r.b, r.exact, round(r.jaccard, 9)) for r in S.similar_pairs(gs, 0.3).collect())
    assert got == want and len(got) > 10


def _uploads(spark, texts, first=0):
    return spark.createDataFrame([(first + i, f"f{first + i}.txt", t) for i, t in enumerate(texts)], UPLOADS)


def _report(spark, root):
    return sorted((r.file_id, r.word_count, r.is_plagiarism, tuple(r.similar_file_ids)) for r in ST.stored_report(spark, root).collect())


def _batch_report(spark, texts):
    from corpuscheck.operators import ingest as I

    cat = I.file_catalog(I.prepare_uploads(_uploads(spark, texts)))
    return sorted((r.file_id, r.word_count, r.is_plagiarism, tuple(r.similar_file_ids)) for r in RP.document_report(cat).collect())


def test_a_batch_that_stops_is_not_seen_and_runs_again(spark, monkeypatch):
    texts = _texts(6, 24)
    root = os.path.join(scratch_path(spark, "stop"), "state")
    ST.process_batch(_uploads(spark, texts[:12]), 0, root)
    before, catalog = _report(spark, root), ST.read_state(spark, root, "catalog").count()
    begun = SS.begin(spark, root, 1)
    write, calls = SS.Segment.write, []

    def third(self, table, rows):
        calls.append(table)
        if len(calls) == 4:
            raise OSError("stopped")
        return write(self, table, rows)

    monkeypatch.setattr(SS.Segment, "write", third)
    with pytest.raises(OSError):
        ST.process_batch(_uploads(spark, texts[12:], 12), 1, root)
    monkeypatch.setattr(SS.Segment, "write", write)
    assert _report(spark, root) == before and ST.read_state(spark, root, "catalog").count() == catalog
    ST.process_batch(_uploads(spark, texts[12:], 12), 1, root)
    assert _report(spark, root) == _batch_report(spark, texts)
    stamps = {r.created_at for t in ("catalog", "results") for r in ST.read_state(spark, root, t).filter("file_id >= 12").collect()}
    assert stamps == {begun}  # the time it began with, through the stop
    rows = sorted(map(tuple, ST.read_state(spark, root, "results").collect()))
    ST.process_batch(_uploads(spark, texts[12:], 12), 1, root)  # committed: nothing happens
    assert sorted(map(tuple, ST.read_state(spark, root, "results").collect())) == rows and SS.latest(spark, root).version == 1


def test_merged_segments_leave_the_report_unchanged(spark):
    texts = _texts(7, 18)
    root = os.path.join(scratch_path(spark, "merge"), "state")
    for k in range(6):
        ST.process_batch(_uploads(spark, texts[3 * k:3 * k + 3], 3 * k), k, root, fan=2)
        state = SS.latest(spark, root)
        assert state.batch == k and len(state.segments) <= 3
    assert _report(spark, root) == _batch_report(spark, texts)
    members = ST.read_state(spark, root, "members")
    assert sorted(r.batch for r in members.select("batch").distinct().collect()) == list(range(6))
    assert len(SS._names(spark, os.path.join(root, "segments"))) <= 5 and len(SS.versions(spark, root)) <= 3


def test_number_of_segments_grows_with_the_logarithm():
    segments, most = [], 0
    for k in range(400):
        segments = segments + [(f"{k}", 0)]
        while (found := SS.to_merge(segments, 8)) is not None:
            level, names = found
            segments = [s for s in segments if s[0] not in names] + [(f"{k}-{level + 1}", level + 1)]
        most = max(most, len(segments))
    assert most <= 7 * 3


def test_probe_prefixes_hold_only_tokens_of_the_corpus(spark, monkeypatch):
    """A probe's other tokens rank first and meet nothing: they are neither ranked nor written."""
    corpus = _gram_sets(spark, _texts(1, 80))
    stored = RP.store_corpus(corpus)
    written, write = {}, S.materialize

    def spy(df, name):
        written[name] = write(df, name)
        return written[name]

    monkeypatch.setattr(S, "materialize", spy)
    texts = _texts(1, 80)[30:50] + [t + " " + " ".join(f"new{i}x{k}" for k in range(8)) for i, t in enumerate(_texts(1, 80)[50:70])]
    probes = _gram_sets(spark, texts, 500)
    got = _pairs(S.cross_similar(probes, stored.grams, 0.3, True, stored.postings, stored.members))
    known = {r.h for r in stored.postings.rows().select("h").collect()}
    assert {r.h for r in written["probe_prefix"].select("h").collect()} <= known and written["probe_prefix"].count() > 0
    assert {r.h for r in written["probe_tokens"].select("h").collect()} - known
    assert got == _pairs(S.cross_similar(probes, corpus, 0.3)) and len(got) > 30
