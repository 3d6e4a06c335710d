"""Distinct counters by sketches that rounds keep and merge, against the exact numbers."""

from pyspark.sql import functions as F

from crawlspark.operators.counters import distinct_counts, distinct_estimates, distinct_sketches

COUNTED = {"a": F.col("id") % 70_000, "b": F.col("id").cast("string"), "none": F.lit(None).cast("int"), "hot": F.lit("x")}


def test_rounds_merge_within_two_percent(spark):
    rows = [spark.range(0, 120_000, 1, 6), spark.range(60_000, 200_000, 1, 6), spark.range(0)]
    sketches = None
    for part in rows:
        found = distinct_sketches(part, COUNTED)
        sketches = found if sketches is None else sketches.unionByName(found)
    found = {r["name"]: r["value"] for r in distinct_estimates(sketches).collect()}
    exact = {r["name"]: r["value"] for r in distinct_counts(rows[0].union(rows[1]), COUNTED).collect()}
    assert exact == {"a": 70_000, "b": 200_000, "none": 0, "hot": 1}
    assert found["none"] == 0 and found["hot"] == 1
    assert all(abs(found[n] - exact[n]) <= 0.02 * exact[n] for n in exact), found


def test_no_rows(spark):
    empty = distinct_sketches(spark.range(0), COUNTED)
    assert {r["value"] for r in distinct_estimates(empty).collect()} == {0}
    assert distinct_counts(spark.range(0), COUNTED).count() == 0
