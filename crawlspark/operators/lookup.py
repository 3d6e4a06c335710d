"""Look-up joins that hold for small and for large right sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
LEAST_SALTS = 16


def weight(dim: DataFrame) -> list[Column]:
    """Aggregates (rows, bytes) of a look-up table; texts, binaries and nested values count by what they hold."""
    size = F.lit(8 * len(dim.columns))
    for field in dim.schema.fields:
        kind, column = field.dataType.simpleString(), F.col(f"`{field.name}`")
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif kind.startswith(("array<", "map<", "struct<")):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return [F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))]


def is_small(rows: int, size: int, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    return rows <= max_rows and size <= max_bytes


def fits_broadcast(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Weigh a look-up table; one row per task reaches the driver."""
    return is_small(*dim.agg(*weight(dim)).first(), max_rows, max_bytes)


def salts_for(df: DataFrame) -> int:
    """Parts that a hot key is dealt to: as the cluster's shuffle partitions grow, so do they."""
    return max(LEAST_SALTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)


def lookup_join(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
    salts: int | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Join ``df`` to a table that is unique on the keys.

    The table is broadcast when counting proves it small (``small`` hands in an earlier proof). Otherwise the rows of ``df`` are spread
    over ``salts`` copies of the table, so that a key with a third of all rows is no single task.
    """
    on, salts = list(on), salts or salts_for(df)
    if fits_broadcast(dim, max_rows) if small is None else small:
        return df.join(F.broadcast(dim), on, how)
    # by row and by task: neither one key nor many copies of one row stay together
    mixed = F.xxhash64(*[F.col(c) for c in df.columns if _hashable(df, c)], F.spark_partition_id())
    spread = F.pmod(mixed, F.lit(salts))
    left = df.withColumn("_salt", spread)
    right = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def _hashable(df: DataFrame, column: str) -> bool:
    """Cheap to hash: no maps, which have no hash, and no long values."""
    kind = df.schema[column].dataType.simpleString()
    return "map<" not in kind and kind != "binary" and column not in ("html", "content", "content_text")
