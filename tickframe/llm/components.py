"""Connected components by alternating large-star and small-star steps, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    moved = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    return moved.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; the component is named by its smallest node.

    Rows with a null end or equal ends link nothing; repeated rows count once. No edges give no rows.
    """
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    before = _mark(current)
    while before[0]:
        current = _small_star(_large_star(current)).checkpoint()
        after = _mark(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
