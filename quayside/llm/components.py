"""Connected components of an edge table, by alternating star steps.

Every step replaces each node's edges by edges to the smallest node it sees
(first its larger neighbours, then its smaller ones), which halves paths and
ends in one star for each component.  A node's neighbours are never gathered:
a step is a minimum by node (partly aggregated before the shuffle) and a join
with the edges, whose skew adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both(edges)
    least = near.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))   # edges run from the larger to the smaller
    linked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b")
    return linked.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (its smallest node) of every node with an edge to
    another.  Each round's edges are written to the shared folder."""
    now = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    now = written(now, "edges")
    size = F.struct(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0)).alias("sum"))
    before = None
    while before != (mark := now.agg(size.alias("s")).first()["s"]) and mark["n"]:
        before, now = mark, written(_small_star(_large_star(now)), "edges")
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
