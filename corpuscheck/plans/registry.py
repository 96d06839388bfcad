"""Registered queries: one per operator, each over the whole given tables.

Every entry takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the DuckDB oracle in ``corpuscheck.plans.oracle``. Lists of ids
are rendered as ascending comma-joined strings so both engines compare equal.

Arrival order is ascending ``doc_id``. Where an operator needs "stored" data
and a "new batch", the table is split at the midpoint of its ``doc_id`` range
(a scalar subquery): the first half arrived earlier, the rest is the batch. Both halves
are processed, so the work covers the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscheck.functions import text as T
from corpuscheck.operators import ingest as I
from corpuscheck.operators import results as R
from corpuscheck.operators import similarity as S
from corpuscheck.operators import stats as ST
from corpuscheck.operators.verdict import plagiarism_verdict
from corpuscheck.plans import report as RP
from corpuscheck.session import materialize
from corpuscheck.sources import tables as TB

# What the stored rows of the read-through queries differ by.
STORED_WORDS = 1000
# Contents whose byte count is a multiple of this are missing for ``missing_content_tolerant``.
MISSING_BYTES = 4


def _ids_text(c: str):
    return F.array_join(F.col(c).cast("array<string>"), ",")


def _docs(spark, sf):
    return TB.read_table(spark, sf, "documents")


def _prepared(spark, sf):
    """Uploads that pass the gate: documents as ``.txt`` files (pages, ``.html``,
    are refused there)."""
    accepted, _ = I.validate_uploads(TB.document_uploads(spark, sf))
    return I.prepare_uploads(accepted)


def _catalog(spark, sf, with_text=True):
    return I.file_catalog(_prepared(spark, sf), with_text)


def _midpoint_id(spark, sf):
    """Midpoint of the arrival-id range (two bounded aggregates, a scalar
    subquery; an exact median would buffer every id in one task)."""
    return _docs(spark, sf).select(F.expr("(min(doc_id) + max(doc_id)) div 2")).scalar()


def _split_catalog(spark, sf):
    """(history catalogue, full catalogue): history is the catalogue of the
    uploads that arrived before the midpoint of the id range."""
    full = I.file_catalog(_prepared(spark, sf))
    # A file's id is the first upload id of its content, so the catalogue of
    # the earlier uploads is the full catalogue's rows with smaller ids (same
    # first id, same first name) - no second dedupe over the text.
    return full.filter(F.col("file_id") < _midpoint_id(spark, sf)), full


def _report_view(rep: DataFrame) -> DataFrame:
    return rep.select(*RP.REPORT_COLS[:5], _ids_text("similar_file_ids").alias("similar_file_ids"),
                      "word_cloud_location")


# --- 2.1 sources, ingest, dedupe -------------------------------------------

def q_ingest_text(spark, sf):
    accepted, _ = I.validate_uploads(TB.mixed_uploads(spark, sf))
    return accepted.select("origin", "upload_id", "name", T.character_count("text").alias("n_bytes"))


def q_rejected_uploads(spark, sf):
    _, rejected = I.validate_uploads(TB.mixed_uploads(spark, sf))
    return rejected.select("origin", "upload_id", "name", "reason")


def q_content_fingerprint(spark, sf):
    return I.content_fingerprint(TB.document_uploads(spark, sf))


def q_upload_mapping(spark, sf):
    return I.upload_mapping(_prepared(spark, sf))


def q_file_catalog(spark, sf):
    return _catalog(spark, sf, with_text=False).select("file_id", "name", "content_hash", "location", "n_bytes")


def q_incremental_ingest(spark, sf):
    prepared = _prepared(spark, sf)
    midpoint = _midpoint_id(spark, sf)
    stored = I.file_catalog(prepared.filter(F.col("upload_id") < midpoint), with_text=False)
    batch = prepared.filter(F.col("upload_id") >= midpoint)
    new_files, mapping = I.incremental_ingest(stored, batch, with_text=False)
    new_ids = new_files.select("file_id", F.lit(True).alias("new_file"))
    return (mapping.join(new_ids, "file_id", "left")
            .select("upload_id", "file_id", "already_stored",
                    F.coalesce("new_file", F.lit(False)).alias("new_file")))


def q_hash_lookup(spark, sf):
    bench = TB.read_table(spark, sf, "benchmark").select(
        F.lit("benchmark").alias("kind"), F.col("item_id").alias("probe_id"),
        T.sha256_hex("text").alias("content_hash"))
    docs = _docs(spark, sf).select(
        F.lit("documents").alias("kind"), F.col("doc_id").alias("probe_id"),
        T.sha256_hex("text").alias("content_hash"))
    found = I.hash_lookup(_catalog(spark, sf, with_text=False), bench.unionByName(docs))
    return found.select("kind", "probe_id", "content_hash", "file_id")


def q_file_lookup(spark, sf):
    requests = TB.read_table(spark, sf, "labels").select(F.col("doc_id").alias("file_id"))
    return I.file_lookup(_catalog(spark, sf), requests)


# --- 2.2 text scalar / array functions -------------------------------------

def q_paragraph_count(spark, sf):
    return _docs(spark, sf).select("doc_id", T.paragraph_count("text").alias("paragraph_count"))


def q_word_count(spark, sf):
    return _docs(spark, sf).select("doc_id", T.word_count("text").alias("word_count"))


def q_character_count(spark, sf):
    return _docs(spark, sf).select("doc_id", T.character_count("text").alias("character_count"))


def q_doc_stats(spark, sf):
    return ST.doc_stats(_docs(spark, sf))


def q_tokens(spark, sf):
    return ST.token_rows(_docs(spark, sf))


def q_significant_words(spark, sf):
    return ST.significant_word_rows(_docs(spark, sf))


def q_stop_word_filter(spark, sf):
    stops = [w for w in T.DEFAULT_STOP_WORDS if w != "this"]
    w = _docs(spark, sf).select("doc_id", T.significant_words("text", stops).alias("w"))
    return w.select("doc_id", T.normalized_text("w").alias("normalized_text"))


def q_ngrams(spark, sf):
    w = _docs(spark, sf).select("doc_id", T.tokens("text").alias("w"))
    return w.select("doc_id", F.posexplode(T.ngrams("w", 3)).alias("pos", "ngram"))


def q_whitespace_collapsed(spark, sf):
    return _docs(spark, sf).select("doc_id", T.whitespace_collapsed("text").alias("collapsed"))


def q_normalized_text(spark, sf):
    w = _docs(spark, sf).select("doc_id", T.significant_words("text").alias("w"))
    return w.select("doc_id", T.normalized_text("w").alias("normalized_text"))


# --- 2.3 aggregations -------------------------------------------------------

def q_ngram_frequency(spark, sf):
    return S.ngram_frequency(_catalog(spark, sf), 3, id_col="file_id")


def q_word_frequencies(spark, sf):
    return ST.word_frequencies(_docs(spark, sf))


def q_unique_words(spark, sf):
    return ST.unique_words(_docs(spark, sf))


# --- 2.4 similarity and plagiarism ------------------------------------------

def _gram_sets(spark, sf, n=3):
    return S.gram_sets(_catalog(spark, sf), n, id_col="file_id")


def q_normalized_hash(spark, sf):
    w = _catalog(spark, sf).select("file_id", T.significant_words("text").alias("w"))
    return w.select("file_id", T.sha256_hex(T.normalized_text("w")).alias("norm_hash"))


def q_exact_duplicates(spark, sf):
    """Over raw documents, which hold byte copies, and a second edition of each
    in other case and with other punctuation (odd ids)."""
    docs = _docs(spark, sf)
    first = docs.select((F.col("doc_id") * 2).alias("id"), "text")
    shouted = F.translate("text", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    second = docs.select((F.col("doc_id") * 2 + 1).alias("id"), F.concat(F.lit("("), shouted, F.lit(")!")).alias("text"))
    w = first.unionByName(second).select("id", T.significant_words("text").alias("words"))
    hashed = w.select("id", T.sha256_hex(T.normalized_text("words")).alias("norm_hash"), F.size("words").alias("n_grams"))
    return S.exact_duplicates(hashed).select(F.col("a").alias("file_id_a"), F.col("b").alias("file_id_b"))


def q_pair_jaccard(spark, sf):
    """Jaccard of each catalogued file with the next upload id, if catalogued."""
    gs = _gram_sets(spark, sf)
    ids = gs.select(F.col("id").alias("a"))
    nxt = gs.select(F.col("id").alias("b"))
    pairs = ids.join(nxt, F.col("b") == F.col("a") + 1)
    return S.pair_jaccard(pairs, gs).select(
        F.col("a").alias("file_id_a"), F.col("b").alias("file_id_b"), "jaccard")


def _pairs_view(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("file_id_a"), F.col("b").alias("file_id_b"), "exact", "jaccard")


def q_similar_pairs(spark, sf):
    return _pairs_view(S.similar_pairs(_gram_sets(spark, sf), 0.3))


def q_check_against_corpus(spark, sf):
    probes = TB.benchmark_probes(spark, sf)
    p_gs = S.gram_sets(probes, 3, id_col="probe_id")
    c_gs = _gram_sets(spark, sf)
    stored = RP.store_corpus(c_gs)
    pairs = S.cross_similar(p_gs, stored.grams, 0.3, False, stored.postings, stored.members)
    edges = pairs.select(F.col("probe").alias("probe_id"), F.col("doc").alias("similar_file_id"))
    v = plagiarism_verdict(probes, edges, id_col="probe_id")
    return v.select("probe_id", "is_plagiarism", _ids_text("similar_file_ids").alias("similar_file_ids"))


def q_prior_similar(spark, sf):
    return S.earlier_similar(*S.similar_classes(_gram_sets(spark, sf), 0.3))


def q_plagiarism_verdict(spark, sf):
    gs = _gram_sets(spark, sf)
    edges = S.earlier_similar(*S.similar_classes(gs, 0.3))
    v = plagiarism_verdict(gs.select(F.col("id").alias("file_id")), edges)
    return v.select("file_id", "is_plagiarism", _ids_text("similar_file_ids").alias("similar_file_ids"))


def q_tunable_similarity(spark, sf):
    return _pairs_view(S.similar_pairs(_gram_sets(spark, sf, n=2), 0.2))


# --- 2.5 result tables and report -------------------------------------------

def q_upsert_results(spark, sf):
    """Base: a stored row for every file, with other counts; new: the files from
    the midpoint on. Only those are replaced."""
    # base, new and the ids that it replaces each read the report
    report = materialize(_full_report(spark, sf), "report")
    base = report.withColumn("word_count", F.col("word_count") + STORED_WORDS).withColumn("is_plagiarism", ~F.col("is_plagiarism"))
    new = report.filter(F.col("file_id") >= _midpoint_id(spark, sf))
    return R.upsert_results(base, new, stamp=False).select(*R.RESULT_COLS)


def q_insert_ignore_similar(spark, sf):
    """Base: the edges up to the midpoint, and all edges the other way round;
    new: every edge."""
    # read four times below
    edges = materialize(RP.report_edges(_catalog(spark, sf)), "edges")
    back = edges.select(F.col("similar_file_id").alias("file_id"), F.col("file_id").alias("similar_file_id"))
    base = edges.filter(F.col("file_id") < _midpoint_id(spark, sf)).unionByName(back)
    return R.insert_ignore_similar(base, edges)


def _full_report(spark, sf):
    return RP.document_report(_catalog(spark, sf))


def q_result_lookup(spark, sf):
    requests = _docs(spark, sf).select(F.col("doc_id").alias("file_id"))
    return R.result_lookup(_full_report(spark, sf), requests)


def q_similar_lookup(spark, sf):
    """Stored classes and links, expanded for the requested files."""
    cat = _catalog(spark, sf)
    members, links = RP.report_classes(cat)
    requests = cat.select("file_id")
    out = R.similar_lookup(S.earlier_similar(members, links, requests), requests)
    return out.select("file_id", _ids_text("similar_file_ids").alias("similar_file_ids"))


def q_analyzed_ids(spark, sf):
    # a report has a row for each catalogued file, so its ids need no report
    return R.analyzed_ids(_catalog(spark, sf, with_text=False))


def q_document_report(spark, sf):
    return _report_view(_full_report(spark, sf))


def q_incremental_report(spark, sf):
    history, full = _split_catalog(spark, sf)
    h_a = RP.analyse(history)
    stored, stored_edges = RP.report_with_edges(history, analysed=h_a)
    # stored rows that a recompute would not give must come back as they are
    stored = materialize(stored.withColumn("word_count", F.col("word_count") + STORED_WORDS), "report")
    results, _ = RP.incremental_report(stored, stored_edges, full, stored=RP.store_corpus(h_a))
    return _report_view(results)


def q_missing_content_tolerant(spark, sf):
    requests = TB.read_table(spark, sf, "labels").select(F.col("doc_id").alias("file_id"))
    catalog = _catalog(spark, sf)
    contents = catalog.filter(F.col("n_bytes") % MISSING_BYTES != 0).select("location", "text")
    out = RP.analyze_requests(catalog, requests, contents)
    return out.select("file_id", "status", "error", *RP.REPORT_COLS[1:5],
                      _ids_text("similar_file_ids").alias("similar_file_ids"))


def q_stream_report(spark, sf):
    from corpuscheck.streaming.stream import stream_report_from_table

    return _report_view(stream_report_from_table(spark, sf, n_batches=4))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ingest_text": q_ingest_text,
    "rejected_uploads": q_rejected_uploads,
    "content_fingerprint": q_content_fingerprint,
    "upload_mapping": q_upload_mapping,
    "file_catalog": q_file_catalog,
    "incremental_ingest": q_incremental_ingest,
    "hash_lookup": q_hash_lookup,
    "file_lookup": q_file_lookup,
    "paragraph_count": q_paragraph_count,
    "word_count": q_word_count,
    "character_count": q_character_count,
    "doc_stats": q_doc_stats,
    "tokens": q_tokens,
    "significant_words": q_significant_words,
    "stop_word_filter": q_stop_word_filter,
    "ngrams": q_ngrams,
    "whitespace_collapsed": q_whitespace_collapsed,
    "normalized_text": q_normalized_text,
    "ngram_frequency": q_ngram_frequency,
    "word_frequencies": q_word_frequencies,
    "unique_words": q_unique_words,
    "normalized_hash": q_normalized_hash,
    "exact_duplicates": q_exact_duplicates,
    "pair_jaccard": q_pair_jaccard,
    "similar_pairs": q_similar_pairs,
    "check_against_corpus": q_check_against_corpus,
    "prior_similar": q_prior_similar,
    "plagiarism_verdict": q_plagiarism_verdict,
    "tunable_similarity": q_tunable_similarity,
    "upsert_results": q_upsert_results,
    "insert_ignore_similar": q_insert_ignore_similar,
    "result_lookup": q_result_lookup,
    "similar_lookup": q_similar_lookup,
    "analyzed_ids": q_analyzed_ids,
    "document_report": q_document_report,
    "incremental_report": q_incremental_report,
    "missing_content_tolerant": q_missing_content_tolerant,
    "stream_report": q_stream_report,
}
