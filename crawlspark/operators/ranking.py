"""Ranks and top-n without a single-task window.

A window without keys, or with one very hot key, sorts everything in one task. Here Spark deals the rows to
ranges of (keys, order), each range is ranked on its own and written, and the number of earlier rows of the same key is added. A key
reaches past a range only as its last key, so a row per range says it all: its first key, its last key and how many rows that has.
The driver sees only Spark's own sample for the ranges, which is bounded; the ranks are exact whatever the ranges are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.operators.lookup import lookup_join, weight
from crawlspark.session import work_dir

#: rows, and bytes by what they hold, of a range
ROWS_PER_BUCKET, BYTES_PER_BUCKET = 1_000_000, 64 << 20
SMALL_TOP = 10_000

Order = Sequence[tuple[str, Column]]


def rank_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    name: str = "rank",
    limit: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add the 1-based position of each row among the rows with the same ``keys``.

    ``order`` holds (alias, ascending column) pairs that together break all ties (negate a number to
    sort it descending). Keys and order are strings, integers or doubles and never null. With ``limit``
    only rows up to that position stay; ranges keep no more than that of a key. Many rows are written once to the shared
    folder, in as many ranges as ``rows_per_bucket`` and BYTES_PER_BUCKET ask for, so a range's task reads no more as the table or its texts grow.
    """
    keys = list(keys)
    typed = df.withColumns({f"_o_{alias}": column for alias, column in order})
    order_cols = [f"_o_{alias}" for alias, _ in order]
    rows, size = df.agg(*weight(df)).first()
    ranges = max(-(-rows // rows_per_bucket), -(-size // BYTES_PER_BUCKET))
    if ranges <= 1:
        by_key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
        ranked = typed.withColumn(name, F.row_number().over(by_key.orderBy(*order_cols)).cast("bigint"))
        return _first(ranked, name, limit).drop(*order_cols)

    dealt = typed.repartitionByRange(ranges, *keys, *order_cols)
    if keys:
        inside = Window.partitionBy("_b", *keys).orderBy(*order_cols)
        placed = dealt.withColumn("_b", F.spark_partition_id()).withColumn(name, F.row_number().over(inside).cast("bigint"))
    else:
        # ids that Spark gives along a sorted partition: its number, then 33 bits of the row's place
        placed = dealt.sortWithinPartitions(*order_cols).withColumn("_id", F.monotonically_increasing_id())
        place = F.col("_id").bitwiseAND((1 << 33) - 1) + 1
        placed = placed.withColumns({"_b": F.shiftright("_id", 33).cast("int"), name: place}).drop("_id")
    # written, because Spark may draw other ranges when it deals the rows again
    placed = _written(_first(placed, name, limit).drop(*order_cols))
    offsets = _offsets(placed, keys, name)
    ranked = lookup_join(placed, offsets, [*keys, "_b"]).withColumn(name, F.col(name) + F.coalesce("_off", F.lit(0)))
    return _first(ranked, name, limit).select(*df.columns, name)


def top_rows(df: DataFrame, order: Order, n: int, name: str = "rank", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The first ``n`` rows with their positions.

    A short list is Spark's own top-k; a long one would push n rows of every task through one
    task, so it is cut by :func:`rank_rows` instead.
    """
    if n <= SMALL_TOP:
        columns = [column for _, column in order]
        first = df.orderBy(*columns).limit(n)
        return first.withColumn(name, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*columns)).cast("bigint"))
    return rank_rows(df, [], order, name, limit=n, rows_per_bucket=rows_per_bucket)


def _first(ranked: DataFrame, name: str, limit: int | None) -> DataFrame:
    return ranked if limit is None else ranked.where(F.col(name) <= limit)


def _written(df: DataFrame) -> DataFrame:
    path = work_dir(df.sparkSession, "ranks")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _offsets(placed: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, _b, _off): rows of a range's first key in earlier ranges, where there are any; at most a row per range.

    Earlier ranges that hold this key have it as their last one. With a limit their counts end there, which suffices to rule later rows out.
    """
    by = keys or ["_k"]
    fields = [F.col(k) for k in keys] or [F.lit(0).alias("_k")]
    ends = placed.groupBy("_b").agg(F.min(F.struct(*fields)).alias("lo"), F.max(F.struct(*fields, F.col(name).alias("_n"))).alias("hi"))
    starts = ends.select("_b", "lo.*", F.lit(0).cast("bigint").alias("_n"))
    met = starts.unionByName(ends.select("_b", "hi.*")).groupBy(*by, "_b").agg(F.sum("_n").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return met.withColumn("_off", F.sum("_n").over(before)).where("_off > 0").select(*keys, "_b", "_off")
