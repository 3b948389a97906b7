"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.storage import saved


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) of every vertex of the edges (a, b) that isn't its component's smallest.

    Edges point from the larger end to the smaller. A round writes one table; all its shuffles combine
    before they send, and the join that meets a large component's centre is split by adaptive execution.
    """
    star = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    while not _settled(star):
        star = saved(_round(star), "star")
    return star.select(F.col("u").alias("id"), F.col("v").alias("comp"))


def _settled(star: DataFrame) -> bool:
    """Every vertex points to one other at most, and what is pointed to points nowhere."""
    one, none = F.lit(1), F.lit(0)
    ends = star.select(F.col("u").alias("x"), one.alias("out"), none.alias("into")).unionByName(
        star.select(F.col("v").alias("x"), none.alias("out"), one.alias("into")))
    return ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into")).filter("out > 1 or (out > 0 and into > 0)").isEmpty()


def _round(star: DataFrame) -> DataFrame:
    # large star: the larger neighbours of a vertex move to the smallest of it and its neighbours
    both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("m", "u").alias("m")).hint("rebalance")
    large = star.select(F.col("v").alias("w"), F.col("u").alias("x")).join(lowest, "w").select(F.col("x").alias("u"), F.col("m").alias("v")).distinct()
    # small star: a vertex and its smaller neighbours move to the smallest of them
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def extended(comps: DataFrame, edges: DataFrame) -> DataFrame:
    """``comps`` after more edges (a, b): only what the edges connect is worked on."""
    if edges.isEmpty():
        return comps
    root = lambda end: F.coalesce(f"comp_{end}", end)
    between = edges
    for end in ("a", "b"):
        between = between.join(comps.select(F.col("id").alias(end), F.col("comp").alias(f"comp_{end}")), end, "left")
    above = saved(components(between.select(root("a").alias("a"), root("b").alias("b"))), "above")
    moved = comps.join(above.select(F.col("id").alias("comp"), F.col("comp").alias("top")), "comp", "left")
    return moved.select("id", F.coalesce("top", "comp").alias("comp")).unionByName(above)
