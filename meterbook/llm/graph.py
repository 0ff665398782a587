"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of each node (the larger ones, or the smaller ones and the node) to the least node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(least, "a")
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, root) for every node of the links (a, b): root is the least node that can be reached. Each turn is stored."""
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        edges = stored(_star(_star(edges, True), False))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select("a", F.col("b").alias("root"))
        mark = now
