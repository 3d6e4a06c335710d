"""A keyed table kept in hash buckets, so that changes come to it and it never moves.

Every version of the table is written in the same number of buckets of its key, as a table of the session's catalog with its files in a folder that is
given. Spark joins such a table to others in the tasks of its buckets: only the other side is shuffled. ``put`` merges changes into
it by an outer join, whose tasks are the buckets again, so a new version is written without an exchange of the base.

A bucket is one task's file; choose the number of buckets so that a bucket fits a task (the table's bytes over some 200 MB). It is a
property of the table and stays when it is read again by ``open_buckets``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def default_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_buckets(df: DataFrame, folder: str, buckets: int, key: str = "key", dealt: bool = False) -> DataFrame:
    """Write ``df`` in buckets of ``key`` and read it back. ``dealt`` says that each task's rows are of one bucket already; else they are shuffled once."""
    rows = df if dealt else df.repartition(buckets, key)
    name = f"buckets_{uuid.uuid4().hex}"
    rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", folder).saveAsTable(name)
    return df.sparkSession.table(name)


def open_buckets(spark: SparkSession, folder: str, buckets: int, key: str = "key") -> DataFrame:
    """A table that another session wrote: its folder under a new name, with the number of buckets it was written in."""
    name = f"buckets_{uuid.uuid4().hex}"
    schema = spark.read.parquet(folder).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"create table {name} ({columns}) using parquet clustered by (`{key}`) sorted by (`{key}`) into {buckets} buckets location '{folder}'")
    return spark.table(name)


def latest_changes(changes: DataFrame, buckets: int, key: str = "key", version: str | None = None) -> DataFrame:
    """One row per key of ``changes``, the latest by ``version``, dealt as the buckets are, so that it meets the table without another shuffle."""
    dealt = changes.repartition(buckets, key)
    if version is None:
        return dealt
    rest = [c for c in changes.columns if c != key]
    return dealt.groupBy(key).agg(F.max_by(F.struct(*rest), version).alias("r")).select(key, "r.*")


def put(base: DataFrame, changes: DataFrame, buckets: int, key: str = "key", version: str | None = None) -> DataFrame:
    """The bucketed ``base`` with ``changes`` in place of its rows of the same keys, and those of new keys added.

    The result has the columns of ``base``; a column that changes lack is null in their rows. ``base`` has one row per key, and so have ``changes``
    unless ``version`` orders them. Rows without a key match nothing and are kept.
    """
    latest = latest_changes(changes, buckets, key, version)
    have = set(latest.columns)
    fields = [(F.col(f"`{c}`") if c in have else F.lit(None).cast(base.schema[c].dataType)).cast(base.schema[c].dataType).alias(c) for c in base.columns]
    old = base.select(F.col(f"`{key}`").alias("_old"), F.struct(*[F.col(f"`{c}`") for c in base.columns]).alias("_was"))
    new = latest.select(F.col(f"`{key}`").alias("_new"), F.struct(*fields).alias("_is"))
    met = old.join(new, F.col("_old") == F.col("_new"), "full_outer")
    return met.select(F.coalesce("_is", "_was").alias("r")).select("r.*")


def merge(base: DataFrame, changes: DataFrame, folder: str, buckets: int, key: str = "key", version: str | None = None) -> DataFrame:
    """``put`` written as the table's next version: the join's tasks are the buckets, so the base is read and written in place."""
    return write_buckets(put(base, changes, buckets, key, version), folder, buckets, key, dealt=True)


def absent(rows: DataFrame, base: DataFrame, key: str = "key") -> DataFrame:
    """``rows`` whose key the bucketed ``base`` lacks; the base's keys are read where they lie."""
    return rows.join(base.select(key), key, "left_anti")
