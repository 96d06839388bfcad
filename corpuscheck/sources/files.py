"""Raw file source: uploaded text files read whole with the binaryFile format.

Spark lists and reads the files in parallel; each file is one row holding its
bytes. Names starting with ``_`` or ``.`` are skipped by Spark's file listing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, BinaryType, TimestampType

BINARY_FILE_SCHEMA = StructType([
    StructField("path", StringType(), False),
    StructField("modificationTime", TimestampType(), False),
    StructField("length", LongType(), False),
    StructField("content", BinaryType(), True),
])


def file_name(path_col: str = "path"):
    """Last path element (URL-decoded form as listed by Spark)."""
    return F.regexp_extract(F.col(path_col), r"([^/]*)$", 1)


def read_upload_files(spark: SparkSession, path: str, recursive: bool = True,
                      glob: str | None = None) -> DataFrame:
    """All files under ``path`` as uploads ``(path, name, modified, content)``.

    Every file is kept so the ``.txt`` gate can report the rest as refused;
    pass ``glob="*.txt"`` to list only candidates.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.load(path)
    return raw.select(
        F.col("path"),
        file_name("path").alias("name"),
        F.col("modificationTime").alias("modified"),
        F.col("content"),
    )


def with_arrival_ids(uploads: DataFrame) -> DataFrame:
    """Give uploads increasing ids in arrival order (modification time, path).

    Only ``(path, modified)`` goes through the distributed sort; the id
    generated right after it grows with partition index and row position, so
    it is unique and ordered without funnelling rows through one task. Ids are
    not dense. The contents meet their ids by path.
    """
    ids = (uploads.select("path", "modified").orderBy("modified", "path")
           .select("path", F.monotonically_increasing_id().alias("upload_id")))
    return uploads.join(ids, "path")
