"""Stored results: upserts that touch few partitions, look-ups that read few row groups; per-byte decoding."""

from __future__ import annotations

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from corpuscheck.functions import text as T
from corpuscheck.operators import results as R
from corpuscheck.operators import similarity as S
from corpuscheck.session import scratch_path
from corpuscheck.sources import files as FS

RESULT = "file_id long, paragraph_count int, word_count int, character_count int, is_plagiarism boolean, word_cloud_location string"


def _files(path):
    out = {}
    for d, _, names in os.walk(path.replace("file:", "")):
        out |= {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
    return out


def test_an_upsert_rewrites_touched_partitions_only(spark):
    store = R.ResultStore(spark, scratch_path(spark, "result-store"), 16)
    rows = [(i, 1, i, i, False, None) for i in range(400)]
    store.upsert(spark.createDataFrame(rows, RESULT))
    assert sorted(tuple(r)[:6] for r in store.rows().collect()) == rows
    before, stamps = _files(store.path), {r.file_id: r.created_at for r in store.rows().collect()}
    assert len(before) >= 16 and len(set(stamps.values())) == 1
    time.sleep(0.05)
    new = [(7, 9, 9, 9, True, "w"), (7, 9, 9, 9, True, "w"), (1000, 1, 1, 1, False, None)]
    store.upsert(spark.createDataFrame(new, RESULT))
    got = {r.file_id: r for r in store.rows().collect()}
    assert len(got) == 401 and tuple(got[7])[:6] == new[0] and tuple(got[1000])[:6] == new[2]
    assert {i for i, r in got.items() if r.created_at != stamps.get(i)} == {7, 1000}
    after = _files(store.path)
    same = {f for f in before if after.get(f) == before[f]}
    assert len(before) - len(same) <= 2 and len(same) >= 14
    assert sorted(r.file_id for r in store.lookup([7, 1000, 5, 99999]).collect()) == [5, 7, 1000]
    assert store.lookup([]).count() == 0


def _scanned(df):
    """Rows that the scans of an executed plan gave out."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0

    def walk(node):
        nonlocal total
        if "FileSourceScan" in node.getClass().getSimpleName():
            total += node.metrics().apply("numOutputRows").value()
        for name in ("finalPhysicalPlan", "plan"):
            if name in {m.getName() for m in node.getClass().getMethods()} and "Adaptive" in node.getClass().getSimpleName() + name:
                return walk(getattr(node, name)())
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(plan)
    return total


def test_a_look_up_reads_few_row_groups(spark):
    path = scratch_path(spark, "keyed")
    rows = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("content_hash"), F.col("id").alias("file_id"))
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        R.write_keyed(rows, path, "content_hash", row_group_bytes=64 * 1024)
        table = spark.read.parquet(path)
        assert len(table.inputFiles()) >= 60
        rng = random.Random(1)
        ids = [rng.randrange(200_000) for _ in range(10)]
        wanted = [r.content_hash for r in rows.filter(F.col("file_id").isin(ids)).collect()]
        found = R.keyed_lookup(table, "content_hash", wanted)
        assert sorted(r.file_id for r in found.collect()) == sorted(ids)
        assert 0 < _scanned(found) < 0.05 * 200_000
        absent = R.keyed_lookup(table, "content_hash", ["f" * 63 + "x"])
        assert absent.collect() == [] and _scanned(absent) < 0.05 * 200_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _go_runes(raw: bytes) -> str:
    """One U+FFFD for each byte that belongs to no valid sequence."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + n].decode("utf-8"))
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def test_each_stray_byte_is_one_replacement(spark):
    rng = random.Random(3)
    raws = [b"", b"ab\xe2", b"ab\xe2\x82", b"\xf0\x9f\x98x", "é€😀".encode(), b"\xed\xa0\x80", b"\xc0\xaf", b"\xf4\x90\x80\x80", b"\x80\x80", b"\xe2\x82\xac\xac"]
    raws += [bytes(rng.choice([0x41, 0x20, 0x80, 0xBF, 0x9F, 0xA0, 0xC2, 0xE0, 0xE2, 0xED, 0xF0, 0xF4, 0x82, 0xAC, 0xFF]) for _ in range(rng.randrange(1, 9)))
             for _ in range(600)]
    df = spark.createDataFrame([(i, bytearray(r)) for i, r in enumerate(raws)], "id long, content binary")
    for column in (F.col("content"), F.col("content").cast("string")):
        got = {r.id: r.t for r in df.select("id", T.decoded(column).alias("t")).collect()}
        assert got == {i: _go_runes(r) for i, r in enumerate(raws)}


@pytest.mark.parametrize("one, two", [(b"ab\xe2", b"ab\xe2\x82")])
def test_broken_files_normalise_by_their_bytes(spark, tmp_dir, one, two):
    """Read through ``binaryFile``: texts that differ in a stray byte aren't copies of each other."""
    from corpuscheck.operators import ingest as I

    for name, raw in (("a.txt", one), ("b.txt", two), ("c.txt", one + b" ")):
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(raw)
    uploads = FS.with_arrival_ids(FS.read_upload_files(spark, tmp_dir))
    catalog = I.file_catalog(I.prepare_uploads(uploads))
    hashes = {r.name: r.norm_hash for r in S.gram_sets(catalog, 3, keep=("name",)).collect()}
    assert hashes["a.txt"] == hashes["c.txt"] != hashes["b.txt"]
