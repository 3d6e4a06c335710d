"""Index sink."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_index(rows: DataFrame, path: str, max_rows_per_file: int = 1_000_000) -> None:
    """Write index rows; a rerun replaces the folder, so a retry writes no row twice."""
    rows.write.mode("overwrite").option("maxRecordsPerFile", max_rows_per_file).parquet(path)
