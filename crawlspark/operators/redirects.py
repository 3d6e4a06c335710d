"""Chains of redirects, followed to their end by pointer doubling.

Every source points to its target. In each step a source that points to another source takes over what that one points to, so pointers double in
length and a chain of n hops is done in about log n joins, each of distinct sources against the table of sources; a step is written to the
shared folder, so no plan grows and a lost executor costs one step. A hub that a third of all sources point to is looked up through
``lookup_join``, whose salts spread it.

A chain that runs into a cycle never ends. Once pointers are longer than there are sources, whatever still points to a source is such
a chain; it keeps its own source as its end and is marked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.operators.domains import choose_representative
from crawlspark.operators.lookup import fits_broadcast, lookup_join
from crawlspark.session import work_dir


def _written(df: DataFrame) -> DataFrame:
    path = work_dir(df.sparkSession, "redirects")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def first_targets(redirects: DataFrame, src: str = "src", dst: str = "dst", temporary: str = "temp") -> DataFrame:
    """(src, dst, temp): one redirect per source, the smallest target if there are several; redirects to oneself are none."""
    real = redirects.where(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst)))
    one = real.groupBy(F.col(src).alias("src")).agg(F.min(F.struct(F.col(dst).alias("dst"), F.col(temporary).alias("temp"))).alias("r"))
    return one.select("src", "r.dst", F.coalesce("r.temp", F.lit(False)).alias("temp"))


def follow_redirects(redirects: DataFrame, src: str = "src", dst: str = "dst", temporary: str = "temp") -> DataFrame:
    """(src, target, hops, temporary, cyclic) of each source: the end of its chain, its length, whether any hop is temporary.

    A chain that runs into a cycle has its source as target, 0 hops and is cyclic. Null ends are no redirects; repeated rows are one.
    """
    state = first_targets(redirects, src, dst, temporary)
    state = _written(state.select("src", F.col("dst").alias("to"), F.lit(1).cast("bigint").alias("hops"), "temp", F.lit(True).alias("open")))
    sources, length = state.count(), 1
    while length <= 2 * sources:
        # only ends that are sources themselves can go on
        ahead = state.select(F.col("src").alias("to"), F.col("to").alias("far"), F.col("hops").alias("more"), F.col("temp").alias("later"))
        met = lookup_join(state.where("open"), ahead, ["to"], small=fits_broadcast(ahead))
        moved = met.select(
            "src",
            F.coalesce("far", "to").alias("to"),
            (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"),
            (F.col("temp") | F.coalesce("later", F.lit(False))).alias("temp"),
            F.col("far").isNotNull().alias("open"),
        )
        state = _written(state.where("not open").unionByName(moved))
        length *= 2
        if state.where("open").isEmpty():
            break
    cyclic = F.col("open")
    return state.select(
        "src",
        F.when(cyclic, F.col("src")).otherwise(F.col("to")).alias("target"),
        F.when(cyclic, 0).otherwise(F.col("hops")).cast("bigint").alias("hops"),
        F.when(cyclic, False).otherwise(F.col("temp")).alias("temporary"),
        cyclic.alias("cyclic"),
    )


def canonical_urls(redirects: DataFrame, suffixes: DataFrame, src: str = "src", dst: str = "dst", temporary: str = "temp") -> DataFrame:
    """``follow_redirects`` with chosen, the url that stands for source and end of a chain by the rule for one redirect; a cyclic source stands for itself."""
    ends = follow_redirects(redirects, src, dst, temporary)
    chosen = choose_representative(ends, F.col("src"), F.col("target"), F.col("temporary"), suffixes, "chosen")
    return chosen.withColumn("chosen", F.when(F.col("cyclic"), F.col("src")).otherwise(F.col("chosen")))
