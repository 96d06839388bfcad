"""Connected components of an edge table, by alternating large-star and small-star.

Every round is two grouped minima (partially aggregated before the shuffle)
joined back to the edges; the minima have one row for each node, so a hub that
holds a large share of all edges is a skewed join that AQE can split. Rounds
are written to the shared checkpoint folder, so lineage stays short and a lost
executor costs one round at most. Nothing but row counts and checksums
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscheck.session import materialize

MAX_ROUNDS = 60


def _stars(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the smallest of u and its listed neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _stars(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    with_least = _stars(down)
    rest = with_least.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionAll(down.groupBy("u").agg(F.min("v").alias("v")))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)``: the smallest node reachable, for every node with an edge.

    Works on any orderable id type. Self loops and rows with a NULL end are
    ignored; repeated edges don't matter; no edges give an empty table.
    """
    now = materialize(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct(), "cc-edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        now = materialize(_small_star(_large_star(now).distinct()).distinct(), "cc-round")
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == mark or row[0] == 0:
            break
        mark = tuple(row)
    else:
        raise RuntimeError("connected components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
