"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.session import settle


def _oriented(edges: DataFrame) -> DataFrame:
    """Each link once, from the larger node to the smaller."""
    return (
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(least.select("a", F.col("low").alias("b")))


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """No node has two parents and no parent has one."""
    parents = edges.select(F.col("b").alias("a")).distinct()
    nested = edges.join(parents, "a", "left_semi").select("a")
    double = edges.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").select("a")
    return nested.unionByName(double).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long, not null); root is the smallest node.

    Every step is an aggregation or a join of narrow rows; a node with very many links is reduced by
    partial minima and its join is split by the optimizer. The links of each round are written and
    read back, so a lost executor costs one round. Rounds grow with the logarithm of the longest path.
    """
    current = settle(_oriented(edges), "links")
    while not _is_forest_of_stars(current):
        current = settle(_oriented(_small_star(_oriented(_large_star(current)))), "links")
    roots = current.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
