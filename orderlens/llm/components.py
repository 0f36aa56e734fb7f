"""Connected components of a graph whose edges never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.session import materialize


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node with an edge to another one.

    Alternates two rewritings until nothing changes: every node links its larger neighbours, then its
    smaller ones, to the smallest node it knows. Edges never grow in number, the rounds grow with the
    logarithm of the longest path, and each round is a written table, so a lost executor costs at most
    one round. A hub is an aggregate and a join, never a list of its neighbours.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    current = materialize(edges.where("u != v").distinct())
    state = None
    while True:
        new = _state(current)
        if new == state or not new[0]:
            break
        state = new
        current = materialize(_small_star(_large_star(current)))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free digest of them."""
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Here every edge points from a larger node to a smaller one."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    smaller = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return smaller.union(own).where("u != v").distinct()
