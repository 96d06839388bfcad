"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def narrow(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only ``(doc_id bigint, text string)``, whatever else the table holds."""
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))


def fold(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id's decimal text modulo ``buckets`` (NULL ids count as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % buckets


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, where: Column | None = None) -> DataFrame:
    """``(doc_id, text, quality)`` of at most ``rows`` labelled documents.

    The sample is the labelled ids with the smallest hashes, so it doesn't
    depend on partitioning. It has a fixed row bound, hence the broadcast.
    """
    ids = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    ids = ids.filter(where) if where is not None else ids
    ids = (ids.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return narrow(docs).join(F.broadcast(ids), "doc_id")


def per_span(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``mask`` over each of the consecutive spans ``bounds[i]:bounds[i + 1]``."""
    out = np.zeros(len(bounds) - 1, np.int64)
    full = bounds[1:] > bounds[:-1]
    if full.any():
        out[full] = np.add.reduceat(mask, bounds[:-1][full], dtype=np.int64)
    return out
