"""Connected components by alternating large-star and small-star steps.

Every step is a group-by with map-side combine and a join; a round is written to the shared folder, so no plan grows
and a lost executor costs one round. No edge or component reaches the driver, which compares a count and a sum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of ``edges`` (a, b: long), root being the smallest node of the component."""
    a, b = F.col("a"), F.col("b")
    state = saved(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "components")
    seen = None
    while True:
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
        state = saved(_small_star(_large_star(state)), "components")
    return state.select(a.alias("node"), b.alias("root")).union(state.select(b, b).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the smallest of its neighbours and itself."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    moved = edges.select(F.col("a").alias("v"), F.col("b").alias("n")).join(least, "n")
    return moved.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours and itself move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()
