"""Connected components by alternating large-star and small-star over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is joined to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # written, so that the join has exchanges of its own and the edges of a node with very many can be split
    low = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "stars")
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is joined to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (long), undirected, repeats and loops allowed. Result: node, component (the smallest node it reaches),
    for every node that an edge joins to another one. Rounds end when no edge changes; each round is written to the shared
    folder, so a lost executor costs a round at most. Only two numbers a round come to the driver."""
    now = written(edges.select("a", "b").where("a != b").distinct(), "edges")
    mark = None
    while True:
        now = written(_small_star(_large_star(now)).where("a != b").distinct(), "edges")
        seen = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
