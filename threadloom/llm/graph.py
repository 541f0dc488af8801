"""Connected components as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadloom.session import materialize


def components(links: DataFrame) -> DataFrame:
    """The smallest reachable node for every node of ``links`` (a, b longs): node, component.

    Links are turned towards smaller neighbours, alternately from the larger and the
    smaller side, until every node hangs on the smallest of its component. Minima are
    combined before the shuffle and handed back by a join, so a node may have any
    number of neighbours. The links of each pass are written once.
    """
    edges = materialize(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    while not finished(edges):
        edges = materialize(small_star(large_star(edges)), "links")
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def finished(edges: DataFrame) -> bool:
    """Whether every larger end hangs on one smaller end that hangs on nothing."""
    parents = edges.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    if not parents.isEmpty():
        return False
    return edges.select(F.col("b").alias("a")).distinct().join(edges.select("a"), "a", "left_semi").isEmpty()


def large_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each node on its least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (
        edges.select(F.col("b").alias("a"), F.col("a").alias("v"))
        .join(least, "a")
        .select(F.col("v").alias("a"), F.col("m").alias("b"))
        .where(F.col("a") != F.col("b"))
    )


def small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    smaller = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return smaller.unionByName(own).where(F.col("a") != F.col("b")).distinct()
