"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from placefolio.session import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``u, v`` for each node with an edge to another: ``v`` is the smallest node of its component, which has no row.

    ``edges`` has columns ``u, v`` of type long; loops and repeated edges do no harm. The number of rounds grows with the
    logarithm of the longest path; every round is written to the shared folder.
    """
    edges = staged(edges.where("u <> v").distinct(), "edges")

    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = None
    while True:
        edges = staged(_small_star(_large_star(edges)), "edges")
        now = state(edges)
        if now == before:
            return edges
        before = now
