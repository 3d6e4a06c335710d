"""Crawl counters and histograms; every group-by here has few groups and combines map-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from crawlspark.functions import options as O
from crawlspark.functions import urls as U
from crawlspark.operators.frontier import YES

# Page states that are counted.
STATUSES = ("UNFETCHED", "FETCHED", "REDIR_TEMP", "REDIR_PERM", "NOTMODIFIED", "RETRY", "GONE")


def inject_counters(lines: DataFrame, line: str = "line") -> DataFrame:
    """Counters of an inject run as (name, value): lines read, and lines with a url that parses."""
    url = O.seed_url(F.col(line))
    return _long(lines.agg(F.count(F.lit(1)).alias("mRows"), F.count_if(U.is_valid_url(url)).alias("mPersist")))


def generate_counters(webdb: DataFrame, now: Column, limit: int | None = None) -> DataFrame:
    """Counters of a generate run as (name, value), in one pass over the table."""
    return _long(webdb.agg(*_generate_counts(now, limit)))


def observe_generate(webdb: DataFrame, now: Column, observation: Observation, limit: int | None = None) -> DataFrame:
    """The same table; whatever runs over it first fills ``observation`` with the counters, without a pass of its own.

    Filters behind it no longer reach the files, so this suits runs that read the whole table anyway.
    """
    return webdb.observe(observation, *_generate_counts(now, limit))


def _generate_counts(now: Column, limit: int | None) -> list[Column]:
    active = ~F.col("mark_inactive").eqNullSafe(F.lit(YES))
    redundant = active & ~F.col("is_seed") & (F.col("fetch_count") > 0)
    later = active & ~redundant & (F.col("fetch_time") > now)
    selected = F.count_if(active & ~redundant & ~later)
    return [
        F.count_if(active).alias("mRows"),
        F.count_if(redundant).alias("redundant"),
        F.count_if(later).alias("mLater"),
        selected.alias("mPersist"),
        selected.alias("rRows"),
        (selected if limit is None else F.least(selected, F.lit(limit).cast("bigint"))).alias("rPersist"),
    ]


def fetch_counters(batch: DataFrame, code: str = "fetch_code", outlinks: str | None = None) -> DataFrame:
    """Counters of a fetch run as (name, value); ``outlinks`` is a column of accepted links per page."""
    ok = F.col(code) == 0
    links = F.coalesce(F.sum(F.when(ok, F.col(outlinks))), F.lit(0)) if outlinks else F.lit(0)
    wide = batch.agg(
        F.count(F.lit(1)).alias("rRows"),
        F.count_if(ok).alias("rFetched"),
        F.count_if(ok).alias("rIndexed"),
        F.count_if(ok).alias("rPersist"),
        links.cast("bigint").alias("rOutlinks"),
    )
    return _long(wide)


def _long(wide: DataFrame) -> DataFrame:
    return wide.unpivot([], wide.columns, "name", "value")


def depth_histogram(webdb: DataFrame, distance: str = "distance") -> DataFrame:
    """Pages by distance 0..3; everything else is N."""
    return _histogram(webdb, F.col(distance), 3, "depth")


def age_day_histogram(rows: DataFrame, at: Column, now: Column) -> DataFrame:
    """Rows by age in whole days 0..7; everything else is N."""
    return _histogram(rows, F.date_diff(now, at), 7, "days")


def _histogram(df: DataFrame, value: Column, last: int, name: str) -> DataFrame:
    bucket = F.when(value.between(0, last), value.cast("string")).otherwise("N")
    return df.groupBy(bucket.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def status_counts(webdb: DataFrame, status: str = "status") -> DataFrame:
    return webdb.where(F.col(status).isin(*STATUSES)).groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def status_line(counters: DataFrame, names: list[str] | None = None, verbose: bool = False) -> DataFrame:
    """``name:value, …`` of the non-zero counters; ``verbose`` puts the group before each name.

    Input is a counter table: one row per group and name, a handful of enumerated names.
    """
    kept = counters.where("value <> 0")
    if names:
        kept = kept.where(F.col("name").isin(*names))
    label = F.concat("grp", F.lit("."), "name") if verbose else F.col("name")
    item = F.concat(label, F.lit(":"), F.col("value").cast("string"))
    ordered = F.array_sort(F.collect_list(F.struct("grp", "name", item.alias("item"))))
    return kept.agg(F.array_join(F.transform(ordered, lambda s: s["item"]), ", ").alias("line"))


def grouped_counters(counters: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Counters of the named groups (all without names), summed per group and name."""
    kept = counters.where(F.col("grp").isin(*groups)) if groups else counters
    return kept.groupBy("grp", "name").agg(F.sum("value").alias("value"))


def counter_lookup(counters: DataFrame, grp: str, name: str, missing: int = -1) -> DataFrame:
    """Value of one counter, ``missing`` when there is none."""
    hit = F.when((F.col("grp") == grp) & (F.col("name") == name), F.col("value"))
    return counters.agg(F.coalesce(F.max(hit), F.lit(missing).cast("bigint")).alias("value"))


#: buckets of a sketch are 2 to this power: an error of about 0.8 % one time in three, 16 KB a sketch
SKETCH_SIZE = 14


def distinct_sketches(rows: DataFrame, counted: dict[str, Column], log_size: int = SKETCH_SIZE) -> DataFrame:
    """One row with a sketch for each name's distinct values, to be kept with the round that it is of.

    Tasks fill sketches of a fixed size, so nothing but these is shuffled. Nulls are not counted; without any value the sketch is empty.
    """
    return rows.agg(*[F.hll_sketch_agg(value.cast("string"), log_size).alias(name) for name, value in counted.items()])


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """(name, value) over all rounds' sketches: what several rounds saw counts once."""
    return _long(sketches.agg(*[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name)), F.lit(0)).alias(name) for name in sketches.columns]))


def distinct_counts(rows: DataFrame, counted: dict[str, Column]) -> DataFrame:
    """(name, value) of the exact numbers, from the rows themselves: the values are shuffled, once each per task."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), v.cast("string").alias("v")) for n, v in counted.items()]))
    distinct = rows.select(pairs.alias("p")).select("p.*").distinct()
    return distinct.groupBy("name").agg(F.count("v").alias("value"))
