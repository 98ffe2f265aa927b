"""Connected components of an edge table by alternating large and small stars.

Each round replaces edges by edges to smaller neighbours with aggregates and
joins only; no node's neighbours are gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest of the node and its neighbours."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("n"), F.least("a", "m").alias("m"))
    return (around.where("b > a").join(least, F.col("a") == F.col("n"))
                  .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = (down.join(least.select(F.col("a").alias("n"), "m"), F.col("a") == F.col("n"))
                  .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return linked.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) → node, root: the smallest node that each node can reach.

    Ends when a round leaves the edge set as it was: every node then points at
    its root.  Nodes without an edge don't appear.
    """
    edges = materialize(edges.where("a <> b").distinct(), "edges")
    mark = None
    while True:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                        ).first()
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        mark = now
