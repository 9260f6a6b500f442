"""Connected components of a large graph by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.staging import staged
from orderlake.operators.joins import join_unique


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang neighbours on the least of each vertex's neighbourhood: the larger neighbours in one operation,
    the smaller ones and the vertex itself in the other. Edges are (a, b) with a < b."""
    reverse = edges.select(F.col("b").alias("v"), F.col("a").alias("u"))
    around = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).union(reverse) if larger else reverse
    least = around.groupBy("v").agg(F.min("u").alias("least"))
    if larger:
        least = least.select("v", F.least("v", "least").alias("least"))
        hung = join_unique(around, least, ["v"], "inner").filter("u > v").select("least", "u")
    else:
        hung = join_unique(around, least, ["v"], "inner").select("least", "u").union(least.select("least", "v"))
    return hung.toDF("a", "b").filter("a < b").distinct()


def _settled(edges: DataFrame) -> bool:
    """All edges are rays of stars: no vertex hangs on two others, or on one while another hangs on it."""
    ends = edges.select(F.col("a").alias("v"), F.lit(0).alias("hung")).union(edges.select("b", F.lit(1)))
    seen = ends.groupBy("v").agg(F.min("hung").alias("least"), F.sum("hung").alias("times"))
    return seen.filter("times > 1 or times = 1 and least = 0").agg(F.count(F.lit(1))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """Every vertex of an edge (a, b), as id, with the smallest id it is connected to, as component.

    Each pass is two joins and is written to the shared folder. A graph of n vertices takes about log(n)
    passes, one that consists of stars none; the driver sees a count after each.
    """
    now = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    now = staged(now, "edges")
    while not _settled(now):
        now = staged(_star(_star(now, True), False), "edges")
    roots = now.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return now.select(F.col("b").alias("id"), F.col("a").alias("component")).union(roots)
