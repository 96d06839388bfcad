"""Upload gate, fingerprints, first-upload-wins dedupe, lookups, file source."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import functions as F

from corpuscheck.operators import ingest as I
from corpuscheck.sources import files as FS


def _uploads(spark, rows):
    return spark.createDataFrame(rows, "upload_id long, name string, text string")


def test_gate_accepts_only_exact_txt(spark):
    ups = _uploads(spark, [(1, "a.txt", "x"), (2, "test.pdf", "x"), (3, "b.TXT", "x"),
                           (4, ".txt", "x"), (5, "c.tar.txt", "x"), (6, "d.txt", None),
                           (7, "e.txt.gz", "x")])
    acc, rej = I.validate_uploads(ups)
    assert sorted(r.upload_id for r in acc.collect()) == [1, 4, 5]
    reasons = {r.upload_id: r.reason for r in rej.collect()}
    assert reasons == {2: I.REASON_NOT_TXT, 3: I.REASON_NOT_TXT, 6: I.REASON_NO_CONTENT,
                       7: I.REASON_NOT_TXT}


def test_fingerprint_is_sha256_hex_of_bytes(spark):
    got = I.content_fingerprint(_uploads(spark, [(1, "a.txt", "héllo")])).first()
    assert got.content_hash == hashlib.sha256("héllo".encode()).hexdigest()


def test_first_upload_wins_id_and_name(spark):
    ups = _uploads(spark, [(7, "late.txt", "same"), (3, "first.txt", "same"), (5, "mid.txt", "same"),
                           (4, "other.txt", "different")])
    prepared = I.prepare_uploads(ups)
    cat = {r.file_id: (r.name, r.location) for r in I.file_catalog(prepared).collect()}
    assert cat == {3: ("first.txt", "3"), 4: ("other.txt", "4")}
    mapping = {r.upload_id: r.file_id for r in I.upload_mapping(prepared).collect()}
    assert mapping == {7: 3, 3: 3, 5: 3, 4: 4}


def test_incremental_ingest_known_hash_returns_existing_id(spark):
    stored = I.file_catalog(I.prepare_uploads(_uploads(spark, [(1, "a.txt", "A"), (2, "b.txt", "B")])))
    batch = I.prepare_uploads(_uploads(spark, [(10, "a2.txt", "A"), (11, "c.txt", "C"), (12, "c2.txt", "C")]))
    new_files, mapping = I.incremental_ingest(stored, batch)
    assert [(r.file_id, r.name) for r in new_files.collect()] == [(11, "c.txt")]
    got = {r.upload_id: (r.file_id, r.already_stored) for r in mapping.collect()}
    assert got == {10: (1, True), 11: (11, False), 12: (11, False)}


def test_unknown_hash_is_empty_not_error(spark):
    cat = I.file_catalog(I.prepare_uploads(_uploads(spark, [(1, "a.txt", "A")])))
    probes = spark.createDataFrame([(hashlib.sha256(b"A").hexdigest(),), ("0" * 64,)], "content_hash string")
    got = {r.content_hash[:1]: r.file_id for r in I.hash_lookup(cat, probes).collect()}
    assert got == {hashlib.sha256(b"A").hexdigest()[:1]: 1, "0": None}


def test_file_lookup_missing_row_and_missing_content(spark):
    cat = I.file_catalog(I.prepare_uploads(_uploads(spark, [(1, "a.txt", "A"), (2, "b.txt", "B")])))
    contents = cat.select("location", "text").filter(F.col("location") == "1")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "file_id long")
    got = {r.file_id: (r.found, r.error) for r in I.file_lookup(cat, ids, contents).collect()}
    assert got[1] == (True, None)
    assert got[2] == (False, "content is missing")
    assert got[3] == (False, "unknown file id 3")


def test_binary_file_source_counts_raw_bytes(spark, tmp_dir):
    blobs = {"a.txt": b"Hello world\n\nSecond", "b.txt": b"ab\xff\xfecd", "c.pdf": b"%PDF", "d.txt": b"Hello world\n\nSecond"}
    for name, data in blobs.items():
        with open(os.path.join(tmp_dir, name), "wb") as fh:
            fh.write(data)
    raw = FS.with_arrival_ids(FS.read_upload_files(spark, tmp_dir))
    acc, rej = I.validate_uploads(raw)
    assert [r.name for r in rej.collect()] == ["c.pdf"]
    prepared = {r.name: r for r in I.prepare_uploads(acc).collect()}
    assert prepared["b.txt"].n_bytes == 6
    assert prepared["b.txt"].content_hash == hashlib.sha256(b"ab\xff\xfecd").hexdigest()
    cat = I.file_catalog(I.prepare_uploads(acc)).collect()
    assert len(cat) == 2  # a.txt and d.txt share bytes


def test_texts_stay_out_of_the_fingerprint_shuffle(spark, tmp_dir):
    path = os.path.join(tmp_dir, "uploads")
    _uploads(spark, [(1, "a.txt", "x"), (2, "b.txt", "x"), (3, "c.txt", "y")]).write.parquet(path)
    prepared = I.prepare_uploads(I.validate_uploads(spark.read.parquet(path))[0])
    cat = I.file_catalog(prepared, with_text=False)
    plan = cat._jdf.queryExecution().executedPlan().toString()
    exchanged = plan[:plan.index("Exchange")]
    assert "text" not in exchanged and "text" not in cat.columns
    assert sorted((r.file_id, r.name) for r in cat.collect()) == [(1, "a.txt"), (3, "c.txt")]


def test_word_frequencies_all_and_top(spark):
    from corpuscheck.operators import stats as ST

    docs = spark.createDataFrame([(1, "pear Apple pear fig apple pear"), (2, "the"), (3, None)], "doc_id long, text string")
    every = [tuple(r) for r in ST.word_frequencies(docs).collect()]
    assert sorted(every) == [(1, 1, "pear", 3), (1, 2, "apple", 2), (1, 3, "fig", 1)]
    assert sorted(tuple(r) for r in ST.word_frequencies(docs, k=1).collect()) == [(1, 1, "pear", 3)]


def test_checkpoint_folder_comes_from_the_session(spark):
    from corpuscheck.session import ensure_checkpoint_dir, scratch_path

    base = ensure_checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(base)
