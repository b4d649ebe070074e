"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stored import discard, stored, viewed


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and its component (its smallest node), for nodes of edges (u, v) that are not it.

    Each round is stored, so a plan never holds more than one round. A hub's neighbours are
    reduced to a minimum in the map tasks; no list of neighbours is ever built. Rounds end
    when the edges do not change, after about log(n) of them.
    """
    edges = stored(edges.select("u", "v").filter("u != v").distinct(), "edges", narrow=True)

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = None
    while (now := state(edges)) != before:
        before = now
        if now[0]:
            last, edges = edges, stored(_small_star(_large_star(edges)), "edges", narrow=True)
            discard(last)
    return viewed(edges.select(F.col("u").alias("node"), F.col("v").alias("component")), edges)
