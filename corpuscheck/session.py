"""Session helpers: building a local session, the shared checkpoint folder,
and writing intermediate tables there so lineage is cut on a written copy.

On a cluster the folder comes from ``spark.checkpoint.dir`` (or an earlier
``SparkContext.setCheckpointDir``). A private folder is created only for a
``local`` master whose session names none; on any other master that is an
error, since executors wouldn't share it.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_PKG_SUBDIR = "corpuscheck"
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "corpuscheck", extra: dict[str, str] | None = None) -> SparkSession:
    """A local session tuned like the cluster profile (AQE on, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Text stages are CPU-bound (regex, n-grams): keep small shuffle
        # partitions apart instead of merging them up to 1 MB.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Byte thresholds: of written tables, and of what AQE has measured.
        .config("spark.sql.autoBroadcastJoinThreshold", "10MB")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder; a private one is created
    only for a ``local`` master whose session names none."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a JVM context (Spark Connect)
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    else:
        conf_dir = None
    conf_dir = conf_dir or spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="corpuscheck-ckpt-")
        if sc is None:
            spark.conf.set("spark.checkpoint.dir", conf_dir)
    if sc is None:
        return conf_dir
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a path in any store that Spark reaches."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath  # noqa: SLF001


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return fs.exists(jpath)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, _PKG_SUBDIR, f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside are removed at its end: nobody
    reads them once the copy is there, and they would lie beside it until the
    driver collects its garbage."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Used for intermediates that later stages read more than once (gram sets,
    ranked tokens): the copy survives executor loss, cuts lineage, and the
    Parquet read gives column pruning to each consumer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with freed_shuffles(spark):
        df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
