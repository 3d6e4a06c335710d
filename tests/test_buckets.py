"""The bucketed table against plain dictionaries, and its plans: only changes are shuffled."""

import random
import re

import pytest
from pyspark.sql import functions as F
from test_plans import plan

from crawlspark.sources import buckets as B

SCHEMA = "key string, name string, n int, version int"


def rows(rng, n, version):
    return [(f"k{rng.randrange(400)}", rng.choice(["a", "b", None]), rng.randrange(99), version) for _ in range(n)]


def exchanges_over(text, folder):
    """Exchanges of the plan's tree between its root and the scan of ``folder``."""
    tree = text.split("\n\n\n")[0].splitlines()
    details = {m[1]: m[0] for m in re.finditer(r"\((\d+)\) Scan parquet[^\n]*\n(?:[^\n]+\n)*", text)}
    ids = [i for i, detail in details.items() if folder in detail]
    at = next(i for i, line in enumerate(tree) if any(line.rstrip().endswith(f"({k})") for k in ids))
    indent = lambda line: len(re.match(r"[\s:+|-]*", line)[0])
    found, depth = [], indent(tree[at])
    for line in reversed(tree[:at]):
        if indent(line) < depth:
            depth = indent(line)
            found += ["Exchange"] * ("Exchange" in line)
    return len(found)


def test_versions_against_dictionaries(spark, tmp_path):
    rng = random.Random(3)
    start = {r[0]: r for r in rows(rng, 500, 0)}
    table = B.write_buckets(spark.createDataFrame([*start.values(), (None, "no key", 1, 0)], SCHEMA), str(tmp_path / "v0"), 4)
    for version in (1, 2, 3):
        changes = rows(rng, 60, version) + [(f"new{version}{i}", "x", i, version) for i in range(5)]
        once = {r[0]: r for r in changes}
        start |= once
        frame = spark.createDataFrame([(k, n, v) for k, _, n, v in once.values()], "key string, n int, version int")
        table = B.merge(table, frame, str(tmp_path / f"v{version}"), 4)
        start = {k: (k, None, r[2], r[3]) if k in once else r for k, r in start.items()}
        assert sorted(map(tuple, table.where("key is not null").collect())) == sorted(start.values())
        assert table.where("key is null").count() == 1
    again = B.open_buckets(spark, str(tmp_path / "v3"), 4)
    assert sorted(map(tuple, again.where("key is not null").collect())) == sorted(start.values())
    assert exchanges_over(plan(B.put(again, frame, 4)), "v3") == 0
    assert B.absent(spark.createDataFrame([("k1", 1), ("none", 2), (None, 3)], "key string, x int"), again).where("key = 'none'").count() == 1


def test_the_latest_of_several_changes_wins(spark, tmp_path):
    base = B.write_buckets(spark.createDataFrame([("a", "old", 0, 0), ("b", "old", 0, 0)], SCHEMA), str(tmp_path / "w"), 3)
    changes = spark.createDataFrame([("a", "first", 1, 1), ("a", "last", 2, 2), ("c", "new", 3, 1)], SCHEMA)
    assert sorted(map(tuple, B.put(base, changes, 3, version="version").collect())) == [("a", "last", 2, 2), ("b", "old", 0, 0), ("c", "new", 3, 1)]
    assert B.put(base, changes.where("n > 9"), 3, version="version").count() == 2


@pytest.mark.parametrize("step", ["put", "absent", "merge"])
def test_the_base_is_never_shuffled(spark, tmp_path, step):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = B.write_buckets(spark.range(1000).select(F.col("id").cast("string").alias("key"), F.lit(0).alias("version")), str(tmp_path / "here"), 5)
        changes = spark.range(990, 1010).select(F.col("id").cast("string").alias("key"), F.lit(1).alias("version"))
        if step == "absent":
            assert exchanges_over(plan(B.absent(changes, base)), "here") == 0 and B.absent(changes, base).count() == 10
        elif step == "put":
            text = plan(B.put(base, changes, 5, version="version"))
            assert exchanges_over(text, "here") == 0 and text.count("hashpartitioning") >= 1
        else:
            merged = B.merge(base, changes, str(tmp_path / "next"), 5)
            assert merged.count() == 1010 and len(list((tmp_path / "next").glob("*.parquet"))) == 5
            assert exchanges_over(plan(B.put(merged, changes, 5)), "next") == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fetched_content_is_moved_for_successes_only(spark, tmp_path):
    from crawlspark.sources.responses import fetch_content

    path = str(tmp_path / "archive")
    spark.createDataFrame([(i, f"<p>{i}") for i in range(50)], "page_id long, html string").write.parquet(path)
    batch = spark.createDataFrame([(1,), (2,), (3,)], "page_id long")
    log = spark.createDataFrame([(1, 200, "2024-01-01", 1), (2, 404, "2024-01-01", 2)], "page_id long, code int, ts string, event_id long")
    out = fetch_content(batch, log, spark.read.parquet(path))
    assert {r["page_id"]: r["html"] for r in out.collect()} == {1: "<p>1", 2: None, 3: None}
    tree = plan(out).split("\n\n\n")[0]
    # the archive meets the wanted keys before its aggregate and exchange
    assert re.search(r"BroadcastHashJoin LeftSemi", tree) and tree.index("LeftSemi") > tree.index("SortAggregate")
