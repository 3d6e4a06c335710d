"""Rounds of generate and fetch on a base table and its deltas."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark.operators.docs import mapped_fields
from crawlspark.operators.links import outlink_pages
from crawlspark.plans.jobs import accepted_outlinks, fetch, fetched_state, generate, index_fields
from crawlspark.session import work_dir
from crawlspark.sources.buckets import absent, default_buckets, merge, put, write_buckets
from crawlspark.sources.sinks import write_index
from crawlspark.sources.webdb import conform, write_snapshot

_STATE = [
    "key", "url", "crawl_opts", "is_seed", "distance", "score", "status", "fetch_priority", "fetch_count",
    "retries_since_fetch", "fetch_interval_s", "create_time", "fetch_time", "prev_fetch_time", "generate_time",
    "fetch_time_history", "batch_id", "mark_inject", "mark_generate", "mark_fetch", "mark_inactive",
]


def crawl_rounds(
    spark: SparkSession,
    table: DataFrame,
    log: DataFrame,
    archive: DataFrame,
    starts: list[dt.datetime],
    top_n: int | None,
    mapping: DataFrame | None = None,
    batch_prefix: str = "b",
    folder: str | None = None,
    stop: Callable[[], bool] | None = None,
    compact_every: int = 8,
    buckets: int | None = None,
) -> DataFrame:
    """One round per start time; returns the last state of the web table, written as a snapshot.

    ``log`` and ``archive`` are keyed by url; a round sees responses up to its start time. A round writes what it fetched, once (state, links and
    index rows read their own columns of it), and then only the rows it changed. The table lies in ``buckets`` of its key, so rounds bring their changes
    and new keys to it and never shuffle it; it is written again, bucket by bucket, every ``compact_every`` rounds, and the links of former rounds with it. Every step starts from written tables, so plans
    never grow and a lost executor costs one step. The loop ends early when a round selects nothing
    or ``stop`` says so.
    """
    folder = folder or work_dir(spark, "rounds")

    def path(kind: str, number: int) -> str:
        return os.path.join(folder, kind, f"round={number}")

    buckets = buckets or default_buckets(spark)
    base = write_buckets(conform(table).select(*_STATE), path("base", 0), buckets)
    deltas: list[str] = []
    links_of: list[str] = []
    for number, start in enumerate(starts, 1):
        if stop and stop():
            break
        now = F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
        state = _current(base, deltas, buckets)
        batch = generate(state, now, f"{batch_prefix}{number}", top_n).drop("rank")
        fetched = write_snapshot(fetch(batch, log, archive, "url", as_of=now), path("fetched", number))
        if fetched.isEmpty():
            break
        # only what this batch's pages linked before
        old_links = spark.read.parquet(*links_of).join(fetched.select("key"), "key", "left_semi") if links_of else None
        links = write_snapshot(_accepted(fetched, old_links), path("links", number))
        links_of.append(path("links", number))
        if mapping is not None:
            write_index(mapped_fields(index_fields(fetched), mapping), path("index", number))
        changed = fetched_state(fetched, now).select(*_STATE)
        fresh = conform(outlink_pages(links, now)).select(*_STATE)
        # the few new keys come to the buckets of the base, then to the deltas
        added = absent(fresh, base)
        added = added.join(spark.read.parquet(*deltas).select("key"), "key", "left_anti") if deltas else added
        write_snapshot(changed.unionByName(added).withColumn("version", F.lit(number)), path("delta", number))
        deltas.append(path("delta", number))
        if number % compact_every == 0:
            base, deltas = merge(base, spark.read.parquet(*deltas), path("base", number), buckets, version="version"), []
            write_snapshot(spark.read.parquet(*links_of).distinct(), path("all_links", number))
            links_of = [path("all_links", number)]
    return write_snapshot(_current(base, deltas, buckets), os.path.join(folder, "final"))


def _current(base: DataFrame, deltas: list[str], buckets: int) -> DataFrame:
    """The base with the latest change of every key; all deltas are one scan."""
    if not deltas:
        return base
    return put(base, base.sparkSession.read.parquet(*deltas), buckets, version="version").select(*_STATE)


def _accepted(fetched: DataFrame, old_links: DataFrame | None) -> DataFrame:
    found = accepted_outlinks(fetched, "key", old_links)
    # one page may link a target many times; the set of old outlinks holds it once
    return found.select("key", "to_url").distinct()
