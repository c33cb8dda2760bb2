"""Connected components of an edge table by alternating large and small stars, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import discard, materialize


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with m, the least of u and its neighbours. Minima are combined before the shuffle."""
    least = edges.groupBy("u").agg(F.min("v").alias("_v")).select("u", F.least("u", "_v").alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _with_least(down)
    out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(linked.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: long) but the least of each component; component is that least node.

    The number of rounds is of the order of the logarithm of the number of nodes.
    """
    edges = materialize(edges.where("u != v").select("u", "v").distinct(), "edges")
    mark = None
    while True:
        before, edges = edges, materialize(_small_star(_large_star(edges)), "stars")
        discard(before)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = tuple(now)
