"""Fetch results as a stream: every micro-batch writes the page states it changed.

The crawl itself is repeated batch work; this is its natural streaming form and nothing more.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from crawlspark.operators import state as S
from crawlspark.sources.responses import latest_responses
from crawlspark.sources.webdb import upsert

COMPACT_EVERY = 16


def changes_of(table: DataFrame, log: DataFrame, key: str = "page_id") -> DataFrame:
    """Rows of the web table that a piece of the fetch log changes: the latest response per page decides."""
    latest = latest_responses(log, key).select(key, "code", F.col("ts").alias("_ts"))
    hit = S.classify_fetches(table.join(latest, key))
    ok = S.schedule_next(S.fetch_success(hit.where("protocol_status = 'SUCCESS'"), F.col("_ts")), F.col("_ts"))
    bad = hit.where("protocol_status <> 'SUCCESS'").withColumn("fetch_code", F.lit(-1))
    bad = S.fetch_backoff(bad, count_failures=True).drop("fetch_code")
    changes = ok.unionByName(bad, allowMissingColumns=True).drop("code", "protocol_status", "_ts")
    return changes.select(*[c for c in table.columns if c in changes.columns])


def apply_log(table: DataFrame, log: DataFrame, key: str = "page_id") -> DataFrame:
    """Web table after a piece of the fetch log."""
    return upsert(table, changes_of(table, log, key), key)


def current(table: DataFrame, folder: str, upto: int, key: str = "page_id", compact_every: int = COMPACT_EVERY) -> DataFrame:
    """The table after micro-batch ``upto``: the last snapshot with the changes written since."""
    spark, start = table.sparkSession, upto - (upto + 1) % compact_every
    if start < 0:
        base, first = table, 0
    else:
        base, first = spark.read.schema(table.schema).parquet(os.path.join(folder, f"state-{start}")), start + 1
    paths = [os.path.join(folder, f"delta-{n}") for n in range(first, upto + 1)]
    if not paths:
        return base
    schema = T.StructType([*table.schema.fields, T.StructField("_batch", T.IntegerType())])
    changes = spark.read.schema(schema).parquet(*paths)
    return upsert(base, changes, key, version="_batch").select(*table.columns)


def update_states(log: DataFrame, table: DataFrame, folder: str, key: str = "page_id", compact_every: int = COMPACT_EVERY) -> DataStreamWriter:
    """Writer that applies a streamed fetch log; :func:`current` reads the table after a micro-batch.

    A micro-batch writes the rows it changed, and the whole table every ``compact_every`` micro-batches. One that runs again
    overwrites its own output from what was before, so a restart neither loses nor doubles a result.
    """

    def run(rows: DataFrame, number: int) -> None:
        before = current(table, folder, number - 1, key, compact_every)
        changes = changes_of(before, rows, key)
        if (number + 1) % compact_every == 0:
            upsert(before, changes, key).select(*table.columns).write.mode("overwrite").parquet(os.path.join(folder, f"state-{number}"))
        else:
            changes.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(os.path.join(folder, f"delta-{number}"))

    return log.writeStream.foreachBatch(run).option("checkpointLocation", os.path.join(folder, "_offsets"))
