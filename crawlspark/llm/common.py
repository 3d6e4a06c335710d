"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark.session import work_dir

#: the white space that separates words, as a character class (fixed by the contracts)
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: for each open ``passing``, the folders that go at its end
PASSING: ContextVar[tuple[list, ...]] = ContextVar("PASSING", default=())


def saved(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: cuts the lineage, survives lost executors.

    Inside of ``passing`` the folder goes at its end, or if ``lasting`` at the end of the one around, if there is one.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    if around := PASSING.get()[: -1 if lasting else None]:
        around[-1].append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing():
    """What is ``saved`` inside is deleted at the end, when the steps that read it are written themselves, but for what is ``lasting``."""
    token = PASSING.set((*PASSING.get(), []))
    try:
        yield
    finally:
        folders = PASSING.get()[-1]
        PASSING.reset(token)
        for spark, path in folders:
            found = spark._jvm.org.apache.hadoop.fs.Path(path)
            found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null counts as empty."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.size(F.split(bare, f"[{SPACE}]+"))
    return F.when(F.coalesce(F.length(bare), F.lit(0)) == 0, 0).otherwise(words).cast("bigint")


def rows_of(batch: pa.RecordBatch, column: str, size: int = 1024) -> Iterator[tuple[int, list]]:
    """(first row, values) of slices of a column, so that few long texts are Python objects at a time."""
    values = batch.column(column)
    for start in range(0, batch.num_rows, size):
        yield start, values.slice(start, size).to_pylist()
