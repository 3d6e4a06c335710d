"""Seed lines, their options, and injection into the web table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions import options as O
from crawlspark.functions import urls as U
from crawlspark.operators.frontier import YES


def split_seeds(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add ``url`` and ``args`` of each seed line."""
    return lines.withColumns({"url": O.seed_url(F.col(line)), "args": O.seed_args(F.col(line))})


def parse_seeds(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add ``url``, ``args``, the parsed ``opts`` struct and its extractor maps."""
    return (
        split_seeds(lines, line)
        .withColumn("opts", O.parse_options(F.col("args")))
        .withColumns({"fields": O.field_extractors(F.col("args"), "F"), "sub_fields": O.field_extractors(F.col("args"), "FF")})
    )


def seed_keywords(lines: DataFrame) -> DataFrame:
    """One row per seed url, keyword and weight."""
    return (
        split_seeds(lines)
        .select("url", O.option_value(F.col("args"), "keywords").alias("text"))
        .where("text is not null")
        .select("url", F.explode(O.weighted_keywords(F.col("text"))).alias("k"))
        .select("url", "k.keyword", "k.weight")
    )


def valid_seeds(lines: DataFrame, line: str = "line") -> DataFrame:
    """Parsed seeds with a url that parses; blank and illegal lines are left out."""
    seeds = parse_seeds(lines, line)
    return seeds.where(U.is_valid_url(F.col("url")))


def inject(lines: DataFrame, now: Column, line: str = "line") -> DataFrame:
    """Seed lines as new rows of the web table, one per key; of repeated urls the last options text wins."""
    seeds = valid_seeds(lines, line)
    rows = seeds.select(
        U.reverse_key(F.col("url")).alias("key"),
        "url",
        O.options_line(F.col("url"), F.col("opts"), F.col("fields"), F.col("sub_fields")).alias("crawl_opts"),
        F.lit(True).alias("is_seed"),
        F.lit(0).alias("distance"),
        F.lit(0.0).cast("float").alias("score"),
        F.lit("UNFETCHED").alias("status"),
        F.col("opts.priority").alias("fetch_priority"),
        F.lit(0).alias("fetch_count"),
        F.lit(0).alias("retries_since_fetch"),
        F.col("opts.interval_s").alias("fetch_interval_s"),
        now.alias("create_time"),
        now.alias("fetch_time"),
        F.lit(YES).alias("mark_inject"),
    )
    rest = [c for c in rows.columns if c != "key"]
    return rows.groupBy("key").agg(F.max_by(F.struct(*rest), "crawl_opts").alias("r")).select("key", "r.*")
