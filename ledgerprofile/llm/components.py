"""Connected components of a graph given as an edge table, by alternating stars.

Each round points every node's larger neighbours at the smallest node near it (large star)
and then every node's smaller neighbours at the smallest of them (small star); the edges end
as one star per component.  Minima are pre-aggregated in each task and joined back with
salts, so a node that a third of all edges share is no hot task.  Lineage is cut by a
stored table per round; the rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerprofile.session import Scratch

SALTS = 8
MAX_ROUNDS = 100


def salt_of(*columns: str, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def every_salt(salts: int = SALTS) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))


def _with_least(pairs: DataFrame, least: DataFrame) -> DataFrame:
    """(u, v, m): the row of ``least`` (u, m) joined to each pair, salted on the pair side."""
    return (pairs.withColumn("salt", salt_of("v"))
            .join(least.withColumn("salt", every_salt()), ["u", "salt"]).select("u", "v", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _with_least(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from larger to smaller nodes."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = _with_least(edges, least).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, root) for each node of an edge; ``root`` is the smallest node it reaches.

    ``edges`` has two columns of one orderable type; loops are ignored.  The result is a
    projection of a stored table.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    a, b = edges.columns
    edges = scratch.store(edges.where(F.col(a) != F.col(b))
                          .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        old, edges = edges, scratch.store(_small_star(_large_star(edges)))
        scratch.drop(old)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            roots = edges.select(F.col("v").alias("node")).distinct()
            return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
                    .union(roots.select("node", F.col("node").alias("root"))))
        before = now
    raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
