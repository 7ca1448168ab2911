"""Connected components of a graph given as edges, by alternating large-star and small-star rounds.

Every round is a group minimum and a join on the node, written to the shared checkpoint folder;
the edges of the finished graph are stars around each component's smallest node. A hub's
edges are combined before the shuffle for its minimum, and its join partition can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strata.session import materialize


def star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node u that are larger (``large``), or u and its smaller ones, to the least of u and these all."""
    if large:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    else:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    far = near.join(least, "u")
    out = far.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")) if large else (
        far.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m")))
    return out.filter("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (columns a, b of type long); component: the smallest node reachable."""
    edges, before = edges.select("a", "b").filter("a <> b").distinct(), None
    while True:
        # the write counts and sums up the edges as it goes; equal twice means that nothing changed
        seen = Observation()
        edges = materialize(star(star(edges, True), False).observe(
            seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")), "edges")
        now = (seen.get["n"], seen.get["sum"])
        if now == before or not now[0]:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
