"""Connected components of a graph that is given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.session import stage_table


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the component's smallest node.

    Alternating large-star and small-star steps: every node sends its larger, then
    its smaller neighbours to the smallest one it knows. The number of links never
    grows, and the steps needed grow with the logarithm of the nodes. Each
    step is written to the shared folder; no node's links are gathered in one place.
    """
    edges = links.select("a", "b").where("a != b")
    edges = stage_table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    last = None
    while True:
        edges = stage_table(_small_star(_large_star(edges)), "links")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == last:
            break
        last = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to the smallest of u and its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionAll(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
