"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from castledger.llm.common import Tables


def _with_least(neighbours: DataFrame) -> DataFrame:
    """Each (u, v) with the least of u and all its v. The least is found by an
    aggregation that combines map-side, so a vertex of any degree is no hot group."""
    least = neighbours.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    return neighbours.join(least, "u")


def large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of u with the least of u and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """Link u and its smaller neighbours with the least of them."""
    joined = _with_least(edges)
    return (joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(joined.select("u", F.col("m").alias("v"))).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether each u has one edge only and no v is a u."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where(
        (F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))).isEmpty()


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """(vertex, component) of every vertex of the edges (u, v) but the least of
    each component, which names it. Self-loops are ignored, order and repeats of
    edges don't matter. Each round is written to a table; rounds grow with the
    logarithm of the longest path."""
    current = tables.keep(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _are_stars(current):
        following = tables.keep(small_star(large_star(current)))
        tables.drop(current)
        current = following
    return current.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
