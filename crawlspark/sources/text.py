"""Seed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_seed_lines(spark: SparkSession, path: str, continued: bool = False) -> DataFrame:
    """Seed lines of text files of any size, which are split and read line by line.

    With ``continued`` a line that ends in a backslash goes on in the next one. That needs whole files, one task
    per file, each below Spark's 2 GB for a value.
    """
    if not continued:
        return spark.read.text(path).select(F.col("value").alias("line"))
    return split_seed_text(spark.read.text(path, wholetext=True))


def split_seed_text(texts: DataFrame, text: str = "value") -> DataFrame:
    """Lines of whole texts with continuations joined."""
    joined = F.regexp_replace(text, r"[ \t]*\\[ \t]*\r?\n[ \t]*", " ")
    others = [c for c in texts.columns if c != text]
    return texts.select(*others, F.explode(F.split(joined, r"\r?\n")).alias("line"))
