"""Connected components of an undirected link table, by alternating large and small stars.

Each round is a handful of aggregations and joins whose group-wise part is a minimum (map-side
combined), so no node's neighbours are ever gathered; every round is written to the checkpoint
folder. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch


def _finished(e: DataFrame) -> bool:
    """Whether every node is either a smallest one or linked with exactly one node, a smallest one."""
    role = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    role = role.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not role.where("up > 1 or (up = 1 and down = 1)").agg(F.count(F.lit(1))).first()[0]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node of ``links`` the smallest node that it is connected with."""
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = scratch(e, "links")
    while not _finished(e):
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        low = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
        large = both.where("y > x").join(low, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        e = scratch(small, "small-star")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def extended(label: DataFrame, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The components of what ``label`` (a result of :func:`components`) connects already and of
    further ``links``: only the links between components go through the rounds."""
    at, to = (label.withColumnsRenamed({"node": f"{x}_node", "component": x}) for x in ("at", "to"))
    between = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    between = between.join(at, F.col("a") == F.col("at_node"), "left").join(to, F.col("b") == F.col("to_node"), "left")
    new = components(between.select(F.coalesce("at", "a").alias("a"), F.coalesce("to", "b").alias("b")))
    moved = new.withColumnsRenamed({"node": "part", "component": "whole"})
    old = label.join(moved, F.col("component") == F.col("part"), "left").select(
        "node", F.coalesce("whole", "component").alias("component"))
    return old.unionByName(new.join(label.select("node"), "node", "left_anti").select("node", "component"))
