"""Connected components of a table of links, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowloom.plans.lineage import as_table

MAX_STEPS = 60


def _step(links: DataFrame, large: bool) -> DataFrame:
    """One star step over (a, b) with a > b: every node's larger (or smaller) neighbours move to
    the smallest node around it."""
    if large:
        links = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    if large:
        least = least.withColumn("least", F.least("a", "least"))
    moved = links.join(least, "a")
    if large:
        return moved.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    up = moved.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return up.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node of (a, b): component is its smallest reachable id.

    Links are spread by joins (which split hot nodes) and partial minima; a
    path of n links takes O(log n) steps. Null and self links are ignored.
    """
    state = as_table(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    for _ in range(MAX_STEPS):
        state = as_table(_step(_step(state, True), False), "links")
        now = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    leaves = state.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return leaves.unionByName(leaves.select(F.col("component").alias("id"), "component").distinct())
