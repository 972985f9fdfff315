"""Connected components of an undirected graph, by alternating large and small stars.

Each star step sends a node's neighbours to the smallest of them; the edges end
as stars around each component's smallest node. Every step works on written
tables: its two join inputs are then plain scans with a shuffle each, so AQE
can split a hub's partition, and a lost executor costs one step at most. Only
the last tables stay on disk, whatever the number of rounds. The
minima are aggregates with map-side combine. Nothing goes to the driver but one
flag a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import Slots


def _star(edges: DataFrame, large: bool, minima: Slots, stars: Slots) -> DataFrame:
    """One large or small star over (u, v) with u > v."""
    if large:
        pairs = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        pairs = edges
    least = minima.written(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    linked = pairs.join(least, "u")
    if large:
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return stars.written(out.where(F.col("u") != F.col("v")).distinct())


def _open(edges: DataFrame) -> bool:
    """Whether (u, v) with u > v are not yet stars: a node has two smaller ones, or a smaller and a larger one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).union(edges.select("v", F.lit(0)))
    counted = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("n"))
    return bool(counted.agg(F.max((F.col("up") > 0) & (F.col("n") > 1))).first()[0])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); component is the
    smallest node reachable. Nodes with a null end, and loops, are left out."""
    minima, stars = (Slots(edges.sparkSession, label, keep) for label, keep in (("star-least", 1), ("star-edges", 2)))
    cur = stars.written(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), (F.col("u") != F.col("v")).alias("x"))
        .where("x")
        .select("u", "v")
        .distinct()
    )
    while _open(cur):
        for large in (True, False):
            cur = _star(cur, large, minima, stars)
    roots = cur.select(F.col("v").alias("node")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
