"""Connected components of an edge table, by alternating large-star and
small-star rounds (min-label hooking).  Edges and labels stay distributed; each
round is a grouped minimum (combined before the shuffle) and a narrow join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import written


def _hook(directed: DataFrame) -> DataFrame:
    """(u, v) -> every u's smallest neighbour m, itself included, as (u, v, m)."""
    low = directed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return directed.join(low, "u")


def components(edges: DataFrame) -> DataFrame:
    """edges (u, v) -> (node, component): the smallest node reachable, for
    every node that has an edge to another node."""
    now = written(edges.where("u <> v").select("u", "v").distinct(), "cc")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hook(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        hooked = _hook(down)
        small = hooked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            hooked.select("u", F.col("m").alias("v")))
        now = written(small.where("u <> v").distinct(), "cc")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            # a forest of stars: every node points at its component's smallest
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state
