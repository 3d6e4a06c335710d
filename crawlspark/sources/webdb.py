"""The web table: schema, scan, upsert, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LINK = T.StructType([T.StructField("to_url", T.StringType()), T.StructField("anchor", T.StringType())])


def _fields(names: str, kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names.split()]


WEBPAGE = T.StructType(
    _fields("key url crawl_opts", T.StringType())
    + _fields("is_seed", T.BooleanType())
    + _fields("distance", T.IntegerType())
    + _fields("score", T.FloatType())
    + _fields("status", T.StringType())
    + _fields("fetch_priority fetch_count retries_since_fetch", T.IntegerType())
    + _fields("fetch_interval_s", T.LongType())
    + _fields("create_time fetch_time prev_fetch_time generate_time modified_time", T.TimestampNTZType())
    + _fields("fetch_time_history", T.ArrayType(T.TimestampNTZType()))
    + _fields("batch_id mark_inject mark_generate mark_fetch mark_inactive", T.StringType())
    + _fields("protocol_status", T.StructType(_fields("name message", T.StringType())))
    + _fields("base_url content_type encoding", T.StringType())
    + _fields("headers", T.MapType(T.StringType(), T.StringType()))
    + _fields("content", T.BinaryType())
    + _fields("content_title content_text page_category", T.StringType())
    + _fields("content_text_length", T.IntegerType())
    + _fields("publish_time content_modified_time", T.TimestampNTZType())
    + _fields("outlinks old_outlinks", T.ArrayType(_LINK))
    + _fields("page_entity", T.ArrayType(T.MapType(T.StringType(), T.StringType())))
)

# heavy columns that choosing and scheduling pages never needs
HEAVY = ("content", "content_text", "page_text")


def scan(spark: SparkSession, path: str, columns: list[str] | None = None, crawl_id: str | None = None) -> DataFrame:
    """The web table without its heavy columns, or just the named ones; filters reach the files.

    ``crawl_id`` picks one crawl of a table that is partitioned by it.
    """
    table = spark.read.parquet(path)
    if crawl_id is not None:
        table = table.where(F.col("crawl_id") == crawl_id)
    return table.select(*columns) if columns else table.drop(*HEAVY)


def conform(df: DataFrame) -> DataFrame:
    """All columns of the web table in order; what ``df`` lacks is null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in WEBPAGE.fields
        ]
    )


def upsert(table: DataFrame, changes: DataFrame, key: str = "key", version: str | None = None) -> DataFrame:
    """Put by key: rows of ``changes`` replace rows of ``table``; of several changes the latest wins.

    ``table`` has one row per key. Changes are reduced to one row per key before they meet it.
    """
    latest = changes
    if version:
        rest = [c for c in changes.columns if c != key]
        latest = changes.groupBy(key).agg(F.max_by(F.struct(*rest), version).alias("r")).select(key, "r.*")
    kept = table.join(latest.select(key), key, "left_anti")
    return kept.unionByName(latest, allowMissingColumns=True)


def write_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write a snapshot and read it back, which also cuts the lineage."""
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)
