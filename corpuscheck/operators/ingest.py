"""Upload gate, content fingerprints and the deduplicated file catalogue.

Rules kept from the original service:

* only names whose last extension is exactly ``.txt`` are accepted (case
  sensitive); an upload without content is refused;
* a file's fingerprint is the lower-hex SHA-256 of its raw bytes;
* equal bytes are stored once: every upload maps to the id of the *first*
  upload with those bytes, and the catalogue row keeps that first upload's
  name; the location of a stored file is its id;
* looking up an unknown hash is an empty answer, not an error.

Dedupe is a ``groupBy(content_hash)`` with partial aggregation, so a hash that
holds a large share of all uploads collapses to one row per map task before
the shuffle; no window runs over a hash group. Texts take no part in it: the
catalogue's texts are fetched by the winning ids, and only where they are
asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscheck.functions import text as T

REASON_NO_CONTENT = "no content"
REASON_NOT_TXT = "name does not end in .txt"


def _accept_reason(name: Column, content: Column) -> Column:
    return (F.when(content.isNull(), F.lit(REASON_NO_CONTENT))
            .when(name.isNull() | ~name.endswith(".txt"), F.lit(REASON_NOT_TXT)))


def validate_uploads(uploads: DataFrame, content_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Split uploads into ``(accepted, rejected)``; ``rejected`` has ``reason``.

    Both halves come from one predicate, so each row lands in exactly one.
    """
    content_col = content_col or ("content" if "content" in uploads.columns else "text")
    reason = _accept_reason(F.col("name"), F.col(content_col))
    tagged = uploads.withColumn("reason", reason)
    accepted = tagged.filter(F.col("reason").isNull()).drop("reason")
    rejected = tagged.filter(F.col("reason").isNotNull())
    return accepted, rejected


def prepare_uploads(uploads: DataFrame) -> DataFrame:
    """Normalise an upload frame to ``(upload_id, name, content_hash, n_bytes, text)``.

    Hash and byte count come from the raw bytes when a ``content`` column is
    present (invalid UTF-8 then still counts as raw bytes); otherwise from the
    UTF-8 bytes of ``text``. Uploads have passed the gate, so content is
    present; a NULL would count as the empty hash.
    """
    if "content" in uploads.columns:
        src = F.col("content")
        text = F.col("content").cast("string")
    else:
        src = F.col("text")
        text = F.col("text")
    return uploads.select(
        F.col("upload_id").cast("long").alias("upload_id"),
        F.col("name"),
        # never NULL, so that a join on it needs no second sha2 to filter NULLs
        F.coalesce(T.sha256_hex(src), F.lit("")).alias("content_hash"),
        T.character_count(src).alias("n_bytes"),
        text.alias("text"),
    )


def content_fingerprint(uploads: DataFrame) -> DataFrame:
    """``(upload_id, name, content_hash)`` for every upload; no content, no hash."""
    src = "content" if "content" in uploads.columns else "text"
    return uploads.select(F.col("upload_id").cast("long").alias("upload_id"), "name", T.sha256_hex(src).alias("content_hash"))


def upload_mapping(prepared: DataFrame) -> DataFrame:
    """``(upload_id, file_id)``: each upload -> first upload with equal bytes.

    The first id per hash is a partially aggregated ``min``; joining it back on
    the hash is an equi-join whose one-row-per-key side lets AQE split a hot
    hash on the other side.
    """
    ids = prepared.select("upload_id", "content_hash")
    first = ids.groupBy("content_hash").agg(F.min("upload_id").alias("file_id"))
    return ids.join(first, "content_hash").select("upload_id", "file_id")


def file_catalog(prepared: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per distinct content: the first upload's id and name win.

    Returns ``(file_id, name, content_hash, location, n_bytes)`` and ``text``.
    Without texts nothing but hashes, names and counts is shuffled.
    """
    first = (prepared.groupBy("content_hash")
             .agg(F.min("upload_id").alias("file_id"),
                  F.min_by("name", "upload_id").alias("name"),
                  F.min_by("n_bytes", "upload_id").alias("n_bytes"))
             .select("file_id", "name", "content_hash",
                     F.col("file_id").cast("string").alias("location"), "n_bytes"))
    if not with_text:
        return first
    return first.join(_texts(prepared), "file_id")


def _texts(prepared: DataFrame) -> DataFrame:
    """``(file_id, text)``, to be met by id in an exchange: at any size that needs a
    cluster the ids are too many to send to all tasks, and the work on texts
    that follows is dealt evenly, however few row groups they came in."""
    return prepared.select(F.col("upload_id").alias("file_id"), "text").hint("merge")


def incremental_ingest(catalog: DataFrame, batch: DataFrame, with_text: bool = True) -> tuple[DataFrame, DataFrame]:
    """Ingest a prepared batch against a stored catalogue.

    Returns ``(new_files, mapping)``: ``new_files`` are catalogue rows for
    contents not stored before (first upload of the batch wins), ``mapping``
    maps every batch upload to the stored id when its hash is known, else to
    the new id. The new catalogue is ``catalog.unionByName(new_files)``.
    """
    batch_files = file_catalog(batch, with_text=False)
    known = catalog.select("content_hash", F.col("file_id").alias("known_id"))
    new_files = batch_files.join(known, "content_hash", "left_anti")
    if with_text:
        new_files = new_files.join(_texts(batch), "file_id")
    ids = batch.select("upload_id", "content_hash")
    first_in_batch = batch_files.select("content_hash", F.col("file_id").alias("batch_id"))
    mapping = (ids.join(first_in_batch, "content_hash")
               .join(known, "content_hash", "left")
               .select("upload_id", F.coalesce("known_id", "batch_id").alias("file_id"),
                       F.col("known_id").isNotNull().alias("already_stored")))
    return new_files, mapping


def hash_lookup(catalog: DataFrame, probes: DataFrame, hash_col: str = "content_hash") -> DataFrame:
    """For every probe hash, the stored id or NULL (unknown is not an error)."""
    stored = catalog.select(F.col("content_hash").alias(hash_col), "file_id")
    return probes.join(stored, hash_col, "left")


def file_lookup(catalog: DataFrame, ids: DataFrame, contents: DataFrame | None = None,
                id_col: str = "file_id") -> DataFrame:
    """Fetch ``(name, text)`` for requested ids.

    Metadata comes from the catalogue, content by location from ``contents``
    (``(location, text)``; defaults to the catalogue's own text). A missing
    metadata row or missing content yields ``found = false`` and an ``error``.
    """
    meta = catalog.select(F.col("file_id").alias(id_col), "name", "location")
    if contents is None:
        contents = catalog.select("location", "text")
    looked = (ids.select(id_col).join(meta, id_col, "left")
              .join(contents.select("location", "text"), "location", "left"))
    error = (F.when(F.col("name").isNull(), F.concat(F.lit("unknown file id "), F.col(id_col).cast("string")))
             .when(F.col("text").isNull(), F.lit("content is missing")))
    return looked.select(id_col, "name", "text", error.isNull().alias("found"), error.alias("error"))
