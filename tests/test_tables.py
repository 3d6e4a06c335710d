import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from crawlspark.operators import counters as K
from crawlspark.operators import docs as D
from crawlspark.operators import frontier as R
from crawlspark.operators import lookup
from crawlspark.operators import ranking as G
from crawlspark.operators import state as S
from crawlspark.plans import jobs as J
from crawlspark.plans.rounds import crawl_rounds
from crawlspark.sources import xml as XS
from crawlspark.sources.responses import fetch_content, latest_responses
from crawlspark.sources.sinks import write_index
from crawlspark.sources.webdb import WEBPAGE, conform, scan, upsert

T0 = dt.datetime(2024, 1, 5)
NOW = F.lit(T0).cast("timestamp_ntz")


# --- ranks --------------------------------------------------------------------------------------


def skewed(spark, n=600):
    rnd = random.Random(5)
    rows = [("hot" if rnd.random() < 0.4 else f"k{rnd.randrange(30)}", rnd.randrange(50), f"u{i}") for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, a int, u string").repartition(7)


def expected(rows, keyed):
    out, seen = {}, {}
    for k, a, u in sorted(rows, key=lambda r: ((r[0],) if keyed else ()) + (-r[1], r[2])):
        g = k if keyed else ""
        seen[g] = seen.get(g, 0) + 1
        out[u] = seen[g]
    return out


@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("per_bucket", [1_000_000, 50, 7])
def test_rank_rows(spark, keyed, per_bucket):
    rows, df = skewed(spark)
    order = [("a", -F.col("a")), ("u", F.col("u"))]
    ranked = G.rank_rows(df, ["k"] if keyed else [], order, rows_per_bucket=per_bucket)
    assert {r.u: r["rank"] for r in ranked.collect()} == expected(rows, keyed)
    assert ranked.columns == ["k", "a", "u", "rank"]


def test_rank_rows_with_limit(spark):
    rows, df = skewed(spark)
    order = [("a", -F.col("a")), ("u", F.col("u"))]
    want = {u: r for u, r in expected(rows, False).items() if r <= 77}
    assert {r.u: r["rank"] for r in G.rank_rows(df, [], order, limit=77, rows_per_bucket=20).collect()} == want
    assert {r.u: r["rank"] for r in G.top_rows(df, order, 77).collect()} == want


def test_long_top_list_is_cut_in_buckets(spark, monkeypatch):
    rows, df = skewed(spark)
    monkeypatch.setattr(G, "SMALL_TOP", 10)
    got = G.top_rows(df, [("u", F.col("u"))], 100, rows_per_bucket=50)
    assert sorted((r["rank"], r.u) for r in got.collect()) == list(enumerate(sorted(u for *_, u in rows)[:100], 1))


def test_ranges_split_a_hot_key(spark, monkeypatch):
    _, df = skewed(spark)
    order = [("a", -F.col("a")), ("u", F.col("u"))]
    written = []
    monkeypatch.setattr(G, "_written", lambda d, plain=G._written: written.append(plain(d)) or written[-1])
    G.rank_rows(df, ["k"], order, rows_per_bucket=50)
    assert written[0].where("k = 'hot'").select("_b").distinct().count() >= 2
    offsets = G._offsets(written[0], ["k"], "rank")
    assert offsets.count() <= written[0].select("_b").distinct().count()


@pytest.mark.parametrize("n", [0, 1, 5])
@pytest.mark.parametrize("per_bucket", [20, 10**6])
def test_first_rows_of_each_key(spark, n, per_bucket):
    rows, df = skewed(spark)
    got = G.rank_rows(df, ["k"], [("u", F.col("u"))], limit=n, rows_per_bucket=per_bucket).collect()
    want = {(k, u, i) for k in {r[0] for r in rows} for i, u in enumerate(sorted(x[2] for x in rows if x[0] == k)[:n], 1)}
    assert {(r.k, r.u, r["rank"]) for r in got} == want


def test_bounds_hold_no_texts(spark):
    texts = [(1, "f", 1, "x" * 50_000 + str(i)) for i in range(60)]
    fields = spark.createDataFrame(texts, "id int, field string, rnk int, value string")
    got = D.add_values(fields, rows_per_bucket=10)
    assert sorted(r.pos for r in got.select("pos").collect()) == list(range(60))
    assert "xxxxxxxxxx" not in got._jdf.queryExecution().analyzed().toString()


def test_lookup_join_small_and_salted(spark):
    rows, df = skewed(spark)
    dim = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, v int")
    for how in ("left", "inner"):
        small = lookup.lookup_join(df, dim, ["k"], how).select("k", "u", "v").collect()
        salted = lookup.lookup_join(df, dim, ["k"], how, max_rows=1).select("k", "u", "v").collect()
        assert sorted(map(repr, small)) == sorted(map(repr, salted))
    assert lookup.fits_broadcast(dim) and not lookup.fits_broadcast(dim, max_bytes=3)


# --- frontier -----------------------------------------------------------------------------------


def webdb(spark):
    rows = [
        ("http://a/", True, 3, 0.0, 5, None, None, T0),
        ("http://b/", False, 0, 1.9, 5, None, "b1", T0),
        ("http://c/", False, 1, 1.1, 9, None, "b1", T0 - dt.timedelta(days=1)),
        ("http://d/", False, 0, 3.0, 1, "Y", "b2", T0),
        ("http://e/", True, 0, 2.0, 5, "N", None, T0 + dt.timedelta(seconds=1)),
    ]
    schema = "url string, is_seed boolean, fetch_count int, score double, fetch_priority int, mark_inactive string, mark_generate string, fetch_time timestamp_ntz"
    return spark.createDataFrame(rows, schema)


def urls(df):
    return sorted(r.url[7] for r in df.collect())


def test_filters(spark):
    w = webdb(spark)
    assert urls(R.active_pages(w)) == list("abce")
    assert urls(R.batch_pages(w, "b1")) == list("bc")
    assert urls(R.batch_pages(w, "all")) == urls(R.batch_pages(w, None)) == list("abcde")
    assert urls(R.not_redundant(w)) == list("abde")
    assert urls(R.due_pages(w, NOW)) == list("abcd")
    assert urls(R.candidates(w, NOW)) == list("ab")
    assert {r.url[7]: r.fetch_code for r in R.with_generate_code(w).collect()} == {"a": -2, "b": 0, "c": 0, "d": 0, "e": -2}


def test_orders(spark):
    w = webdb(spark)
    assert [r.url[7] for r in R.selector_order(w).orderBy("rank").collect()] == list("debca")
    ranked = [r.url[7] for r in R.priority_order(w, 1).orderBy("rank").collect()]
    assert ranked[0] == "c" and ranked[-1] == "d" and sorted(ranked[1:4]) == list("abe")
    assert ranked == [r.url[7] for r in R.priority_order(w.repartition(5), 1).orderBy("rank").collect()]


def test_short_batch_emits_nothing(spark):
    assert R.generate_per_partition(webdb(spark), NOW, 7, 8).count() == 0
    assert R.generate_per_partition(webdb(spark), NOW, 800, 8).count() == 2


def test_generate_marks(spark):
    rows = J.generate(webdb(spark).withColumn("mark_inject", F.lit("Y")), NOW, "b7", 1).collect()
    assert [(r.url, r["rank"], r.batch_id, r.mark_generate, r.mark_inject) for r in rows] == [("http://a/", 1, "b7", "b7", None)]


def test_last_batch(spark):
    df = spark.createDataFrame([("b1", T0), ("b2", T0 + dt.timedelta(days=1)), (None, None)], "batch_id string, generate_time timestamp_ntz")
    assert R.last_batch_id(df).first()[0] == "b2"
    assert R.last_batch_id(df.where("false")).first()[0] == "all"


# --- state --------------------------------------------------------------------------------------


def test_protocol_status(ask):
    codes = {
        200: "SUCCESS", 300: "MOVED", 301: "MOVED", 302: "TEMP_MOVED", 303: "TEMP_MOVED", 304: "NOTMODIFIED", 305: "MOVED", 307: "TEMP_MOVED",
        308: "MOVED", 400: "GONE", 401: "ACCESS_DENIED", 404: "NOTFOUND", 410: "GONE", 403: "EXCEPTION", 500: "EXCEPTION", 204: "EXCEPTION",
    }
    assert ask(list(codes), S.protocol_status(F.col("x")), "x int") == list(codes.values())


def test_failure_status(ask):
    got = ask(["java.net.ConnectException", "SocketTimeoutException", "UnknownHostException", "IOException", None], S.failure_status(F.col("x")))
    assert got == ["CONNECTION_TIMED_OUT"] * 2 + ["UNKNOWN_HOST", "EXCEPTION", "EXCEPTION"]


def test_redirect_target(ask):
    got = ask([("http://a/b/c", "d"), ("http://a/b/c", None)], S.redirect_target(F.col("u"), F.col("l")), "u string, l string")
    assert got == ["http://a/b/d", "http://a/b/c"]


def test_success_then_schedule(spark):
    w = webdb(spark).withColumn("fetch_interval_s", F.lit(3600).cast("bigint"))
    rows = {r.url[7]: r for r in S.schedule_next(S.fetch_success(w, NOW), NOW).collect()}
    c, e = rows["c"], rows["e"]
    assert (c.status, c.fetch_count, c.mark_fetch, c.mark_generate, c.mark_inactive) == ("FETCHED", 2, "b1", None, "Y")
    assert c.prev_fetch_time == T0 - dt.timedelta(days=1) and c.fetch_time == T0 + dt.timedelta(days=3650)
    assert c.fetch_time_history == [T0] and e.prev_fetch_time is None
    assert e.fetch_time == T0 + dt.timedelta(hours=1) and e.mark_inactive == "N"


def test_backoff(spark):
    rows = [(-1, 2, T0, None), (-2, 6, T0, None), (0, 9, T0, None), (-100, 5, T0, None)]
    df = spark.createDataFrame(rows, "fetch_code int, fetch_count int, fetch_time timestamp_ntz, mark_inactive string")
    got = [(r.fetch_count, (r.fetch_time - T0).days, r.mark_inactive) for r in S.fetch_backoff(df).collect()]
    assert got == [(2, 2, None), (6, 6, "Y"), (9, 0, None), (5, 5, None)]
    assert [r.fetch_count for r in S.fetch_backoff(df, count_failures=True).collect()] == [3, 7, 9, 6]


def test_fetch_content(spark):
    batch = spark.createDataFrame([(1,), (2,), (3,), (4,)], "page_id int")
    log = spark.createDataFrame(
        [(1, 1, T0, 500), (2, 1, T0 + dt.timedelta(1), 200), (3, 2, T0, 404), (4, 4, T0, 200)],
        "event_id int, page_id int, ts timestamp_ntz, code int",
    )
    pages = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "page_id int, html string")
    got = {r.page_id: (r.protocol_status, r.html) for r in fetch_content(batch, log, pages).collect()}
    assert got == {1: ("SUCCESS", "one"), 2: ("NOTFOUND", None), 3: ("EXCEPTION", None), 4: ("SUCCESS", None)}
    assert latest_responses(log).count() == 3


def test_content_as_of_a_time_and_of_several_captures(spark):
    batch = spark.createDataFrame([(1,), (2,)], "page_id int")
    schema = "event_id int, page_id int, ts timestamp_ntz, code int"
    later = T0 + dt.timedelta(1)
    log = spark.createDataFrame([(1, 1, T0, 200), (2, 1, later, 404), (3, 2, later, 200)], schema)
    pages = spark.createDataFrame([(1, "old", T0), (1, "new", later), (2, "x", T0), (2, "x", T0)], "page_id int, html string, seen timestamp_ntz")
    now = F.lit(T0.isoformat(sep=" ")).cast("timestamp_ntz")
    got = fetch_content(batch, log, pages, as_of=now, captured="seen").collect()
    assert sorted((r.page_id, r.protocol_status, r.html) for r in got) == [(1, "SUCCESS", "old"), (2, "EXCEPTION", None)]
    got = fetch_content(batch, log.where("code = 200"), pages, captured="seen").collect()
    assert sorted((r.page_id, r.html) for r in got) == [(1, "new"), (2, "x")]
    assert fetch_content(batch, log.where("code = 200"), pages).count() == 2


def test_index_fields_keep_long_values(spark):
    words = "word " * 40_000
    rows = [("k", "http://a.com/", "Y", 0, f"<html><head><title>T</title></head><body><p>{words}</p></body></html>")]
    fetched = spark.createDataFrame(rows, "key string, url string, mark_generate string, fetch_code int, html string")
    fetched = fetched.withColumns({"crawl_opts": F.lit(None).cast("string"), "is_seed": F.lit(False), "distance": F.lit(0)})
    kept = {r.field: r.value for r in J.index_fields(fetched).collect()}
    assert kept["text_content"] == words.strip() and kept["title"] == "T"
    assert "text_content" not in {r.field for r in J.index_fields(fetched, max_length=1000).collect()}


def test_unmarked_pages_fail_without_being_read(spark):
    batch = spark.createDataFrame([(1, "b1"), (2, None)], "page_id int, mark_generate string")
    log = spark.createDataFrame([(1, 1, T0, 200), (2, 2, T0, 200)], "event_id int, page_id int, ts timestamp_ntz, code int")
    pages = spark.createDataFrame([(1, "one"), (2, "two")], "page_id int, html string")
    got = {r.page_id: (r.fetch_code, r.html) for r in J.fetch(batch, log, pages).collect()}
    assert got == {1: (0, "one"), 2: (-2, None)}


# --- tables -------------------------------------------------------------------------------------


def test_upsert_latest_wins_and_is_idempotent(spark):
    table = spark.createDataFrame([("a", 1, 0), ("b", 1, 0)], "key string, v int, version int")
    changes = spark.createDataFrame([("b", 2, 1), ("b", 3, 2), ("c", 9, 1)], "key string, v int, version int")
    once = upsert(table, changes, version="version")
    assert sorted(map(tuple, once.collect())) == [("a", 1, 0), ("b", 3, 2), ("c", 9, 1)]
    assert sorted(map(tuple, upsert(once, changes, version="version").collect())) == sorted(map(tuple, once.collect()))


def test_conform_and_scan(spark, tmp_path):
    full = conform(webdb(spark).withColumn("content", F.lit("x").cast("binary")))
    assert [f.name for f in full.schema] == WEBPAGE.names
    full.write.parquet(str(tmp_path / "w"))
    seen = scan(spark, str(tmp_path / "w"))
    assert "content" not in seen.columns and "content_text" not in seen.columns
    assert R.candidates(seen, NOW).count() == 2


def test_scan_of_one_crawl(spark, tmp_path):
    two = conform(webdb(spark)).withColumn("crawl_id", F.when(F.col("url") < "http://c", F.lit("x")).otherwise("y"))
    two.write.partitionBy("crawl_id").parquet(str(tmp_path / "w"))
    one = scan(spark, str(tmp_path / "w"), ["url"], crawl_id="x")
    assert urls(one) == list("ab")
    assert "crawl_id" in one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_index_mapping_xml(spark, tmp_path):
    (tmp_path / "m.xml").write_text(
        '<mapping><fields><field name="id" type="string" indexed="true" stored="true" required="true" multiValued="false"/>'
        '<field name="title" type="text" indexed="TRUE" multiValued="true"/></fields><uniqueKey>key</uniqueKey></mapping>'
    )
    rows = XS.read_index_mapping(spark, str(tmp_path / "m.xml")).orderBy("name").collect()
    assert [tuple(r) for r in rows] == [("id", "string", True, True, True, False), ("title", "text", True, False, False, True)]
    assert XS.read_unique_key(spark, str(tmp_path / "m.xml")).first()[0] == "key"
    for extra in ("", "<uniqueKey>a</uniqueKey><uniqueKey>b</uniqueKey>"):
        (tmp_path / "n.xml").write_text(f'<mapping><field name="x"/>{extra}</mapping>')
        assert XS.read_unique_key(spark, str(tmp_path / "n.xml")).first()[0] == "id"


def test_suffix_xml(spark, tmp_path):
    (tmp_path / "s.xml").write_text(
        '<domains><tlds><itlds><tld domain="arpa"><status>INFRASTRUCTURE</status></tld></itlds>'
        '<gtlds><tld domain="com"><description>x</description><boost>2.5</boost></tld><tld domain="org"/></gtlds>'
        '<cctlds><tld domain="de"><country>Germany</country></tld></cctlds></tlds>'
        '<suffixes><suffix domain="co.uk"><status>PSEUDO</status></suffix></suffixes></domains>'
    )
    got = {r.domain: tuple(r)[1:] for r in XS.read_suffixes(spark, str(tmp_path / "s.xml")).collect()}
    assert got == {
        "arpa": ("INFRASTRUCTURE", 1.0, "INFRASTRUCTURE", None),
        "com": ("IN_USE", 2.5, "GENERIC", None),
        "org": ("IN_USE", 1.0, "GENERIC", None),
        "de": ("IN_USE", 1.0, "COUNTRY", "Germany"),
        "co.uk": ("PSEUDO", 1.0, None, None),
    }


# --- documents ----------------------------------------------------------------------------------


def fields(spark):
    rows = [("d", "t", 0, "one"), ("d", "t", 1, None), ("d", "t", 2, ""), ("d", "t", 3, "two"), ("d", "s", 1, "x"), ("d", "s", 0, "y"), ("d", "z", 0, "q")]
    return spark.createDataFrame(rows, "id string, field string, rnk int, value string")


@pytest.mark.parametrize("per_bucket", [1_000_000, 2])
def test_doc_add(spark, per_bucket):
    f = fields(spark)

    def values(**kw):
        return [r.value for r in D.add_values(f, rows_per_bucket=per_bucket, **kw).where("field = 't'").orderBy("pos").collect()]

    assert values() == ["one", None, "", "two"]
    assert values(skip_null=True) == ["one", "", "two"]
    assert values(skip_empty=True) == ["one", "two"]


def test_doc_lists(spark):
    df = spark.createDataFrame([("d", "f", 0, ["a", "b"]), ("d", "f", 1, ["c", "d"])], "id string, field string, rnk int, values array<string>")
    assert [r.value for r in D.add_list_values(df).orderBy("rnk", "in_pos").collect()] == ["a", "b", "[c, d]"]


def test_doc_mapping(spark):
    mapping = spark.createDataFrame([("t", True), ("s", False)], "name string, multi_valued boolean")
    rows = sorted((r.field, r.rnk, r.value) for r in D.sink_rows(fields(spark), mapping).where("value is not null").collect())
    assert rows == [("s", 0, "y"), ("t", 0, "one"), ("t", 2, ""), ("t", 3, "two")]


def test_page_fields_first_writer_wins(spark):
    page = spark.createDataFrame([("k", "a", None, "long value")], "key string, a string, b string, c string")
    got = D.page_fields(page, "key", [{"x": F.col("a")}, {"x": F.col("c"), "y": F.col("b"), "z": F.col("c")}, {"y": F.col("a")}], limit=5)
    assert sorted(map(tuple, got.collect())) == [("k", "x", 0, "a"), ("k", "y", 2, "a")]


def test_doc_values(spark):
    f = fields(spark).where("value is not null")
    assert D.field_value(f, "s").first().value == "y"
    assert sorted(r.field for r in D.field_names(D.remove_field(f, "z")).collect()) == ["s", "t"]
    assert D.value_length(f, 3).count() == 4
    assert D.doc_line(f.withColumn("value", F.concat(F.lit("["), "value", F.lit("]"))), ["t", "s", "none"]).first().line == "\tt:\tone, \ts:\ty"


def test_batches(spark):
    docs = spark.createDataFrame([(f"d{i}",) for i in range(120)], "id string")
    rows = D.batch_numbers(docs, 2, batch=10, rows_per_bucket=25).collect()
    sizes = {}
    for r in rows:
        sizes[r.part, r.batch_no] = sizes.get((r.part, r.batch_no), 0) + 1
    assert len(rows) == 120 and max(sizes.values()) == 10
    assert all(n == 10 for (p, b), n in sizes.items() if (p, b + 1) in sizes)


def test_index_write_is_idempotent(spark, tmp_path):
    out = str(tmp_path / "ix")
    for _ in range(2):
        write_index(fields(spark), out)
    assert spark.read.parquet(out).count() == 7


# --- counters -----------------------------------------------------------------------------------


def test_counters(spark):
    got = {r["name"]: r["value"] for r in K.generate_counters(webdb(spark), NOW, 1).collect()}
    assert got == {"mRows": 4, "redundant": 1, "mLater": 1, "mPersist": 2, "rRows": 2, "rPersist": 1}
    batch = spark.createDataFrame([(0, 3), (-1, 9), (0, None)], "fetch_code int, links int")
    got = {r["name"]: r["value"] for r in K.fetch_counters(batch, outlinks="links").collect()}
    assert got == {"rRows": 3, "rFetched": 2, "rIndexed": 2, "rPersist": 2, "rOutlinks": 3}


def test_observed_counters_cost_no_pass(spark):
    from pyspark.sql import Observation

    seen = Observation()
    table = K.observe_generate(webdb(spark), NOW, seen)
    assert R.candidates(table, NOW).count() == 2
    want = {r["name"]: r["value"] for r in K.generate_counters(webdb(spark), NOW).collect()}
    assert seen.get == want


def test_histograms(spark):
    df = spark.createDataFrame([(d,) for d in (0, 0, 1, 3, 4, -1, None)], "distance int")
    assert {r.depth: r.n for r in K.depth_histogram(df).collect()} == {"0": 2, "1": 1, "3": 1, "N": 3}
    days = spark.createDataFrame([(T0 - dt.timedelta(days=d),) for d in (0, 7, 8, -1)], "at timestamp_ntz")
    assert {r.days: r.n for r in K.age_day_histogram(days, F.col("at"), NOW).collect()} == {"0": 1, "7": 1, "N": 2}


def test_status_line(spark):
    df = spark.createDataFrame([("g", "b", 2), ("g", "a", 1), ("f", "z", 0), ("f", "c", 3)], "grp string, name string, value bigint")
    assert K.status_line(df).first().line == "c:3, a:1, b:2"
    assert K.status_line(df, ["a", "z"], verbose=True).first().line == "g.a:1"
    assert K.counter_lookup(df, "g", "b").first().value == 2
    assert K.counter_lookup(df, "g", "x").first().value == -1 and K.counter_lookup(df, "g", "x", 0).first().value == 0


# --- rounds -------------------------------------------------------------------------------------


def site(spark):
    seeds = spark.createDataFrame([("http://s.com/ -i pt1h -umax 100",), ("http://dead.com/",)], "line string")
    pages = [
        ("http://s.com/", '<a href="/one">link one</a><a href="/two">link two</a><a href="/one">again one</a><a href="/x">x</a>'),
        ("http://s.com/one", "<title>One</title><article><h1>Head</h1>text</article><a href='/deep'>deeper link</a>"),
    ]
    archive = spark.createDataFrame(pages, "url string, html string")
    log = spark.createDataFrame(
        [(1, "http://s.com/", T0, 200), (2, "http://s.com/one", T0, 200), (3, "http://dead.com/", T0, 500)],
        "event_id int, url string, ts timestamp_ntz, code int",
    )
    return seeds, log, archive


@pytest.mark.parametrize("compact_every", [1, 2, 9])
def test_rounds(spark, tmp_path, compact_every):
    seeds, log, archive = site(spark)
    mapping = spark.createDataFrame([("url", False), ("title", False)], "name string, multi_valued boolean")
    starts = [T0, T0 + dt.timedelta(hours=2), T0 + dt.timedelta(hours=4)]
    first = J.inject(None, seeds, NOW)
    final = crawl_rounds(spark, first, log, archive, starts, 100, mapping, folder=str(tmp_path), compact_every=compact_every)
    rows = {r.url: r for r in final.collect()}
    assert len(rows) == final.count()
    assert set(rows) == {"http://s.com/", "http://dead.com/", "http://s.com/one", "http://s.com/two"}
    seed, one, two = rows["http://s.com/"], rows["http://s.com/one"], rows["http://s.com/two"]
    assert seed.fetch_count == 3 and seed.mark_fetch == "b3" and seed.fetch_time_history == starts
    assert one.fetch_count == 1 and one.mark_inactive == "Y" and one.mark_fetch == "b2"
    assert two.status == "UNFETCHED" and two.mark_generate == "b3"
    # known outlinks are not accepted twice
    assert spark.read.parquet(str(tmp_path / "links" / "round=2")).isEmpty()
    index = {(r.id, r.field): r.value for r in spark.read.parquet(str(tmp_path / "index" / "round=2")).collect()}
    assert index["com.s:http/one", "title"] == "Head"
    for n in (1, 2, 3):  # a round changes a page once, in one batch
        delta = spark.read.parquet(str(tmp_path / "delta" / f"round={n}"))
        assert delta.count() == delta.select("key").distinct().count()
        assert {r[0] for r in delta.select("mark_generate").collect()} <= {None, f"b{n}"}


def test_rounds_stop_early(spark, tmp_path):
    seeds, log, archive = site(spark)
    starts = [T0 - dt.timedelta(days=1)] * 3
    final = crawl_rounds(spark, J.inject(None, seeds, NOW), log, archive, starts, 100, folder=str(tmp_path / "a"))
    assert not (tmp_path / "a" / "delta").exists() and final.count() == 2
    crawl_rounds(spark, J.inject(None, seeds, NOW), log, archive, [T0] * 3, 100, folder=str(tmp_path / "b"), stop=lambda: True)
    assert not (tmp_path / "b" / "fetched").exists()


@pytest.mark.parametrize("compact_every", [1, 2, 16])
def test_streamed_log_equals_batch(spark, tmp_path, compact_every):
    from crawlspark.streaming.fetch_log import apply_log, current, update_states

    table = spark.createDataFrame(
        [(i, i % 2 == 0, 0, 60, None, "b1", T0) for i in range(6)],
        "page_id int, is_seed boolean, fetch_count int, fetch_interval_s bigint, mark_inactive string, mark_generate string, fetch_time timestamp_ntz",
    ).withColumns({c: F.lit(None).cast("string") for c in ("status", "mark_fetch", "mark_inject")})
    schema = "event_id int, page_id int, ts timestamp_ntz, code int"
    parts = [[(1, 0, T0, 200), (2, 1, T0, 404), (3, 1, T0 + dt.timedelta(1), 200)], [(4, 0, T0 + dt.timedelta(2), 500), (5, 2, T0, 200)]]
    for n, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "log" / f"p{n}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log" / "*"))
    query = update_states(stream, table, str(tmp_path / "out"), compact_every=compact_every).trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    got = current(table, str(tmp_path / "out"), 1, compact_every=compact_every).orderBy("page_id").collect()
    want = table
    for rows in parts:
        want = apply_log(want, spark.createDataFrame(rows, schema))
    assert [tuple(r) for r in got] == [tuple(r) for r in want.orderBy("page_id").collect()]
    assert got[1].status == "FETCHED" and got[0].fetch_count == 2


def test_ranges_follow_bytes(spark, monkeypatch):
    """Few rows with long texts are dealt to as many ranges as their bytes ask for."""
    monkeypatch.setattr(G, "BYTES_PER_BUCKET", 200_000, raising=False)
    written = []
    monkeypatch.setattr(G, "_written", lambda d, plain=G._written: written.append(plain(d)) or written[-1])
    texts = [(f"d{i % 7}", "f", i, "x" * 50_000 + str(i)) for i in range(60)] + [("d0", "g", 0, None)]
    fields = spark.createDataFrame(texts, "id string, field string, rnk int, value string").repartition(3)
    got = {(r.id, r.field, r.pos, r.value) for r in D.add_values(fields).collect()}
    want = {(i, f, n // 7 if f == "f" else 0, v) for i, f, n, v in texts}
    assert got == want
    assert written and written[0].select("_b").distinct().count() >= 8


def test_multimap_ranges_follow_bytes(spark, monkeypatch):
    monkeypatch.setattr(G, "BYTES_PER_BUCKET", 100_000, raising=False)
    written = []
    monkeypatch.setattr(G, "_written", lambda d, plain=G._written: written.append(plain(d)) or written[-1])
    texts = [("d", "f", i, None if i % 10 == 3 else "y" * 20_000 + str(i)) for i in range(50)]  # one key, its nulls dropped
    got = D.doc_multimap(spark.createDataFrame(texts, "id string, field string, rnk int, value string").repartition(3))
    kept = [v for *_, v in texts if v is not None]
    assert sorted((r.pos, r.value) for r in got.collect()) == list(enumerate(kept))
    sizes = [r["count"] for r in written[0].groupBy("_b").count().collect()]
    assert len(sizes) >= 5 and max(sizes) < 25
