"""Choosing the next pages to fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.operators.domains import HOST, with_partition
from crawlspark.operators.ranking import rank_rows, top_rows

# The mark of a retired page and the name that selects every batch.
YES = "Y"
ALL_BATCHES = "all"


def active_pages(df: DataFrame) -> DataFrame:
    """Pages not marked inactive; a page without the mark is active."""
    return df.where(~F.col("mark_inactive").eqNullSafe(F.lit(YES)))


def batch_pages(df: DataFrame, batch_id: str | None) -> DataFrame:
    """Pages generated for a batch; no batch, or ``all``, selects every page."""
    if batch_id is None or batch_id == ALL_BATCHES:
        return df
    return df.where(F.col("mark_generate") == batch_id)


def not_redundant(df: DataFrame) -> DataFrame:
    """Seeds, and other pages that were never fetched."""
    return df.where(F.col("is_seed") | (F.col("fetch_count") <= 0))


def due_pages(df: DataFrame, now: Column) -> DataFrame:
    """Pages whose fetch time has come; the exact moment counts as due."""
    return df.where(F.col("fetch_time") <= now)


def with_generate_code(df: DataFrame, name: str = "fetch_code") -> DataFrame:
    """-2 for pages without the generate mark, else 0."""
    return df.withColumn(name, F.when(F.col("mark_generate").isNull(), -2).otherwise(0))


def candidates(df: DataFrame, now: Column) -> DataFrame:
    """Active, due pages that are not redundant."""
    return due_pages(not_redundant(active_pages(df)), now)


def selector_order(df: DataFrame, name: str = "rank") -> DataFrame:
    """Position by whole score descending, then url."""
    return rank_rows(df, [], _selector(), name)


def _selector(score: bool = True):
    by_url = [("url", F.col("url"))]
    return [("score", -F.floor("score")), *by_url] if score else by_url


def priority_order(df: DataFrame, run_seed: int = 0, name: str = "rank") -> DataFrame:
    """Position by fetch priority descending; a seeded, repeatable shuffle inside a priority."""
    return rank_rows(
        df,
        [],
        [
            ("priority", -F.col("fetch_priority").cast("bigint")),
            ("mix", F.xxhash64("url", F.lit(run_seed))),
            ("url", F.col("url")),
        ],
        name,
    )


def generate_topn(df: DataFrame, now: Column, n: int | None) -> DataFrame:
    """The first ``n`` candidates by url, or all, with their ranks (the score is the same for all)."""
    if n is None:
        return rank_rows(candidates(df, now), [], _selector(score=False))
    return top_rows(candidates(df, now), _selector(score=False), n)


def generate_per_partition(df: DataFrame, now: Column, n: int, partitions: int, mode: str = HOST, run_seed: int = 0, suffixes: DataFrame | None = None) -> DataFrame:
    """Each partition's first ``n / partitions`` candidates (whole division; may be none)."""
    chosen = with_partition(candidates(df, now), F.col("url"), partitions, mode, run_seed, suffixes)
    return rank_rows(chosen, ["part"], _selector(score=False), limit=n // partitions)


def mark_generated(df: DataFrame, now: Column, batch_id: str) -> DataFrame:
    """Stamp the batch on selected pages and clear their inject mark."""
    return df.withColumns(
        {
            "batch_id": F.lit(batch_id),
            "generate_time": now,
            "mark_generate": F.lit(batch_id),
            "mark_inject": F.lit(None).cast("string"),
        }
    )


def last_batch_id(df: DataFrame) -> DataFrame:
    """The batch generated last, ``all`` when there is none."""
    return df.agg(F.coalesce(F.max_by("batch_id", F.struct("generate_time", "batch_id")), F.lit(ALL_BATCHES)).alias("batch_id"))
