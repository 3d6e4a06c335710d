"""Physical plans: what reaches the scan, what is broadcast, what stays in the JVM."""

import re

import pytest
from pyspark.sql import functions as F

from crawlspark import catalog
from crawlspark.operators import frontier as R
from crawlspark.sources.webdb import conform, scan

SF_DIR = "/root/testdata/sf0.001"
NOW = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")


def plan(df):
    return df._jdf.queryExecution().explainString(_mode(df))


def _mode(df):
    return df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("w") / "webdb")
    conform(spark.createDataFrame([("k", "u", True, 0)], "key string, url string, is_seed boolean, fetch_count int")).write.parquet(path)
    return path


def test_candidates_are_pushed_down(spark, table):
    text = plan(R.candidates(scan(spark, table), NOW).select("key"))
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    for part in ("mark_inactive", "is_seed", "fetch_count", "fetch_time"):
        assert part in pushed, pushed
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "content" not in schema and "headers" not in schema and "crawl_opts" not in schema


def test_batch_mark_is_pushed_down(spark, table):
    assert "EqualTo(mark_generate,b1)" in plan(R.batch_pages(scan(spark, table, ["key", "mark_generate"]), "b1"))


def test_small_top_n_needs_no_full_sort(spark, table):
    assert "TakeOrderedAndProject" in plan(R.candidates(scan(spark, table), NOW).orderBy("url").limit(5))


def test_no_query_multiplies_or_collects(spark):
    for name in catalog.QUERIES:
        if name == "crawl_rounds" or name.endswith("_tolerant"):
            continue
        text = plan(catalog.run(name)(spark, SF_DIR))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
            assert bad not in text, (name, bad)


def test_lookups_broadcast_and_do_not_shuffle_pages(spark):
    for name in ("url_domain", "domain_lookup", "mapped_fields", "enrich_urls"):
        text = plan(catalog.run(name)(spark, SF_DIR))
        assert "BroadcastHashJoin" in text and "hashpartitioning" not in text, name


def test_row_jobs_do_not_shuffle(spark):
    for name in ("extract_pages", "extract_links", "extract_outlinks", "page_text", "robots_meta", "main_content", "charset_resolution"):
        assert "Exchange" not in plan(catalog.run(name)(spark, SF_DIR)), name


def test_title_reads_two_columns(spark):
    schema = re.search(r"ReadSchema: (.*)", plan(catalog.run("page_title")(spark, SF_DIR))).group(1)
    assert "url" not in schema


def test_ranks_are_placed_in_one_shuffle(spark):
    from crawlspark.operators import ranking

    df = spark.range(200).select(F.col("id").cast("string").alias("u"))
    text = plan(ranking.rank_rows(df, [], [("u", F.col("u"))], rows_per_bucket=50))
    # the rows are read as they were dealt and written; only offsets, a row per range, move after that
    assert "Window" not in text.split("BroadcastExchange")[0] and "from_json" not in text
