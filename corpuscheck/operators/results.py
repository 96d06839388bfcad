"""Result tables: ``analysis_results`` and ``similar_files``.

Plain Parquet has no MERGE, so an upsert of frames is ``anti-join + union``.
``ResultStore`` is the stored table: rows hashed by ``file_id`` into a fixed
number of partitions, sorted by it, with Bloom filters on it. An upsert reads
and rewrites only the partitions that new rows fall into; a look-up of given ids
reads only the row groups that may hold them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscheck.session import materialize, path_exists

RESULT_COLS = ("file_id", "paragraph_count", "word_count", "character_count",
               "is_plagiarism", "word_cloud_location")


def upsert_results(base: DataFrame, new: DataFrame, stamp: bool = True) -> DataFrame:
    """Insert or replace every field by ``file_id``; replaced rows get a new
    ``created_at`` (when ``stamp``)."""
    incoming = new.select(*RESULT_COLS)
    if stamp:
        incoming = incoming.withColumn("created_at", F.current_timestamp())
    cols = list(incoming.columns)
    if stamp and "created_at" not in base.columns:
        base = base.withColumn("created_at", F.lit(None).cast("timestamp"))
    kept = base.select(*cols).join(incoming.select("file_id"), "file_id", "left_anti")
    return kept.unionByName(incoming)


def insert_ignore_similar(base: DataFrame, new: DataFrame) -> DataFrame:
    """Add ``(file_id, similar_file_id)`` edges not already present."""
    cols = ["file_id", "similar_file_id"]
    fresh = new.select(*cols).dropDuplicates(cols).join(base.select(*cols), cols, "left_anti")
    return base.select(*cols).unionByName(fresh)


def result_lookup(results: DataFrame, ids: DataFrame, id_col: str = "file_id") -> DataFrame:
    """Results for requested ids; NULL cloud location reads as ``""``;
    an absent id gives ``found = false`` and an error text."""
    r = results.select(F.col("file_id").alias(id_col), *RESULT_COLS[1:], F.lit(True).alias("_hit"))
    out = ids.select(id_col).join(r, id_col, "left")
    found = F.col("_hit").isNotNull()
    return out.select(
        id_col, *RESULT_COLS[1:-1],
        F.when(found, F.coalesce(F.col("word_cloud_location"), F.lit(""))).alias("word_cloud_location"),
        found.alias("found"),
        F.when(~found, F.concat(F.lit("no stored result for file "),
                                F.col(id_col).cast("string"))).alias("error"),
    )


def similar_lookup(edges: DataFrame, ids: DataFrame, id_col: str = "file_id") -> DataFrame:
    """Similar ids of each requested file, ascending; none -> empty list."""
    lists = (edges.groupBy("file_id")
             .agg(F.sort_array(F.collect_list("similar_file_id")).alias("similar_file_ids"))
             .withColumnRenamed("file_id", id_col))
    id_type = dict(edges.dtypes).get("similar_file_id", "bigint")
    out = ids.select(id_col).join(lists, id_col, "left")
    return out.select(id_col, F.coalesce("similar_file_ids", F.array().cast(f"array<{id_type}>"))
                      .alias("similar_file_ids"))


def analyzed_ids(results: DataFrame) -> DataFrame:
    """All analysed ids."""
    return results.select("file_id")


def write_keyed(rows: DataFrame, path: str, key: str, mode: str = "errorifexists", row_group_bytes: int | None = None,
                partition_by: str | None = None) -> None:
    """Write ``rows`` sorted by ``key`` within ranges of it (or within ``partition_by``), with a Bloom filter on it.

    Row-group statistics are then narrow, and the Bloom filters decide what they leave open."""
    dealt = rows.repartition(partition_by) if partition_by else rows.repartitionByRange(F.col(key))
    writer = (dealt.sortWithinPartitions(*[c for c in (partition_by, key) if c]).write.mode(mode)
              .option(f"parquet.bloom.filter.enabled#{key}", "true").option("partitionOverwriteMode", "dynamic"))
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def keyed_lookup(table: DataFrame, key: str, values: Sequence) -> DataFrame:
    """Rows of a ``write_keyed`` table with one of the given key ``values``.

    The values are part of the scan's filter, so row groups whose statistics or
    Bloom filter exclude them are not read. For a request's ids; a table of them
    is joined instead (``result_lookup``)."""
    found = table.filter(F.lit(False))
    values = sorted(set(values))
    # one filter for few values at a time: beyond ten, Spark's readers compare with the least and greatest only
    for i in range(0, len(values), 10):
        found = found.unionAll(table.filter(F.col(key).isin(values[i:i + 10])))
    return found


@dataclass
class ResultStore:
    """``analysis_results`` at ``path``, in ``parts`` partitions by a hash of ``file_id``."""

    spark: SparkSession
    path: str
    parts: int

    def _parted(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("part", F.pmod(F.xxhash64("file_id"), F.lit(self.parts)).cast("int"))

    def read(self) -> DataFrame:
        return self.spark.read.schema(f"{_STORED}, part int").parquet(self.path)

    def rows(self) -> DataFrame:
        return self.read().drop("part")

    def upsert(self, new: DataFrame) -> None:
        """Insert or replace by ``file_id``; only the partitions of ``new`` are read and written.

        Replaced and inserted rows get one new ``created_at``; of repeated ids one
        row stays (the greatest by its fields). The merged partitions are written
        aside first, so that no file is read while it is replaced and a run that
        stops can be repeated."""
        stamp = self.spark.range(1).select(F.current_timestamp()).first()[0]
        incoming = new.groupBy("file_id").agg(F.max(F.struct(*RESULT_COLS[1:])).alias("r")).select("file_id", "r.*")
        incoming = materialize(self._parted(incoming.withColumn("created_at", F.lit(stamp))), "results-new")
        merged = incoming
        if path_exists(self.spark, self.path):
            # as many values as there are partitions at most
            touched = [r.part for r in incoming.select("part").distinct().collect()]
            kept = self.read().filter(F.col("part").isin(touched)).join(incoming.select("file_id"), "file_id", "left_anti")
            merged = materialize(kept.select(*incoming.columns).unionAll(incoming), "results-merged")
        write_keyed(merged, self.path, "file_id", "overwrite", partition_by="part")

    def lookup(self, ids: Sequence[int]) -> DataFrame:
        """Stored rows of given ids; only their partitions' row groups are looked at."""
        part = self._parted(self.spark.createDataFrame([(i,) for i in set(ids)] or [], "file_id bigint"))
        parts = [r.part for r in part.select("part").distinct().collect()]
        return keyed_lookup(self.read().filter(F.col("part").isin(parts)), "file_id", ids).drop("part")


_STORED = ("file_id bigint, paragraph_count int, word_count int, character_count int, is_plagiarism boolean, "
           "word_cloud_location string, created_at timestamp")
