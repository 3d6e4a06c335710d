"""Index pages: ordered, distinct link lists kept as rows (page, pos, to_url)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.operators.lookup import lookup_join
from crawlspark.operators.ranking import ROWS_PER_BUCKET, rank_rows

HOME_LIMIT = 20_000
HOME_KEEP = 16_000


def add_links(old: DataFrame, new: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """New links first, then the old ones; each url once, at its first position."""
    both = new.select("page", "to_url", F.lit(0).alias("_g"), F.col("pos").cast("bigint").alias("_p")).unionByName(
        old.select("page", "to_url", F.lit(1).alias("_g"), F.col("pos").cast("bigint").alias("_p"))
    )
    first = both.groupBy("page", "to_url").agg(F.min(F.struct("_g", "_p")).alias("f")).select("page", "to_url", "f.*")
    return _numbered(first, rows_per_bucket)


def remove_links(old: DataFrame, gone: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Old links without the given ones, renumbered."""
    kept = old.join(gone.select("page", "to_url"), ["page", "to_url"], "left_anti")
    first = kept.groupBy("page", "to_url").agg(F.min(F.col("pos").cast("bigint")).alias("_p"))
    return _numbered(first.withColumn("_g", F.lit(0)), rows_per_bucket)


def cap_links(links: DataFrame, limit: int = HOME_LIMIT, keep: int = HOME_KEEP) -> DataFrame:
    """Pages with more than ``limit`` links keep their first ``keep`` (positions count from 0)."""
    over = links.groupBy("page").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    joined = lookup_join(links, over, ["page"])
    return joined.where(F.col("_n").isNull() | (F.col("pos") < keep)).drop("_n")


def put_first(links: DataFrame, page: str, to_url: str) -> DataFrame:
    """Put one link in front of a page's list."""
    moved = links.withColumn("pos", F.when(F.col("page") == page, F.col("pos") + 1).otherwise(F.col("pos")))
    head = links.sparkSession.range(1).select(
        F.lit(page).alias("page"), F.lit(to_url).alias("to_url"), F.lit(0).cast("bigint").alias("pos")
    )
    return moved.unionByName(head)


def add_old_outlinks(old: DataFrame, accepted: DataFrame) -> DataFrame:
    """The set of old outlinks with the accepted ones added."""
    return old.select("page", "to_url").unionByName(accepted.select("page", "to_url")).distinct()


def _numbered(links: DataFrame, rows_per_bucket: int) -> DataFrame:
    order = [("g", F.col("_g")), ("p", F.col("_p")), ("to_url", F.col("to_url"))]
    ranked = rank_rows(links, ["page"], order, "_r", rows_per_bucket=rows_per_bucket)
    return ranked.select("page", "to_url", (F.col("_r") - 1).alias("pos"))
