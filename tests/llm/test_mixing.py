"""Mixing: the SQL check, water-filling against a plain loop, targets met within a document, odd rows, the mixed rows themselves."""

import random

import pytest
from pyspark.sql import functions as F

from crawlspark.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, size string"


def make(spark, seed=3, n=400):
    rng = random.Random(seed)
    names = ["a", "b", "ä", "z", None, ""]
    return spark.createDataFrame(
        [(i, " ".join(["w"] * rng.randint(0, 30)), "a" if rng.random() < 0.4 else rng.choice(names), "clash") for i in range(n)], SCHEMA
    )


def targets(sizes, weights, cap=3):
    """The plain loop: share out, clamp what is above, share out the excess."""
    total, clamped = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in clamped]
        level = (total - sum(clamped.values())) / max(1, sum(weights[s] for s in free))
        over = {s: cap * sizes[s] for s in free if weights[s] * level > cap * sizes[s]}
        if not over:
            return clamped | {s: weights[s] * level for s in free}
        clamped |= over


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_takes(spark, seed):
    docs = make(spark, seed)
    rows = M.takes(docs).collect()
    sizes, taken, most = {}, {}, {}
    for r in rows:
        s = r["source"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["size"] * r["repeats"]
        most[s] = max(most.get(s, 0), r["size"])
        assert 0 <= r["repeats"] <= 3
    names = sorted((s for s in sizes if s is not None)) + [None]
    want = targets(sizes, {s: 1 + i % 3 for i, s in enumerate(names)})
    assert len(rows) == 400 and sum(want.values()) == pytest.approx(sum(sizes.values()))
    for r in rows:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
    for s in names:
        assert abs(taken[s] - want[s]) <= most[s] / 2
    assert sorted(map(repr, rows)) == sorted(map(repr, M.takes(docs).collect()))


def test_clamped_sources(spark):
    docs = spark.createDataFrame([(i, "w " * 100, "big", "") for i in range(50)] + [(100 + i, "w", f"s{i}", "") for i in range(5)], SCHEMA)
    rows = {r["source"]: r for r in M.takes(docs).collect()}
    assert all(rows[f"s{i}"]["repeats"] == 3 and rows[f"s{i}"]["target"] == 3 for i in range(5))
    assert rows["big"]["target"] == 5005 - 15


def test_mixed_rows(spark):
    docs = make(spark).withColumn("key", F.lit("clash"))
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    want = {r["doc_id"]: r["repeats"] for r in M.takes(docs).collect() if r["repeats"]}
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == want


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, None, ""), (1, "", "x", ""), (1, " \t\n ", "x", ""), (2, "same text", "y", ""), (2, "same text", "y", "")], SCHEMA)
    rows = M.takes(docs).collect()
    assert len(rows) == 5 and len({r["repeats"] for r in rows if r["source"] == "y"}) == 1
    empty = docs.limit(0)
    assert M.takes(empty).count() == 0 and M.mix(empty).count() == 0
