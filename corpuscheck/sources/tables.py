"""Table sources: the driver's Parquet tables and upload views over them.

An *upload* is ``(upload_id bigint, name string, text string)`` or, from raw
files, ``(upload_id, name, content binary)``. Ascending ``upload_id`` is the
arrival order.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def document_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each ``documents`` row as an uploaded ``.txt`` file named after its
    source and id; ``doc_id`` is the upload id and the arrival order."""
    docs = read_table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").alias("upload_id"),
        F.format_string("%s-%d.txt", F.col("source"), F.col("doc_id")).alias("name"),
        F.col("text"),
    )


def page_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each ``pages`` row as an uploaded ``.html`` file (refused at the gate)."""
    pages = read_table(spark, sf_dir, "pages")
    return pages.select(
        F.col("page_id").alias("upload_id"),
        F.format_string("page-%d.html", F.col("page_id")).alias("name"),
        F.col("html").alias("text"),
    )


def mixed_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and web pages uploaded together; ``origin`` tells them apart
    (ids are only unique within one origin)."""
    return (document_uploads(spark, sf_dir).withColumn("origin", F.lit("documents"))
            .unionByName(page_uploads(spark, sf_dir).withColumn("origin", F.lit("pages"))))


def benchmark_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``benchmark`` items as probe texts ``(probe_id, text)``."""
    return read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("probe_id"), F.col("text"))
