import pytest
from pyspark.sql import functions as F

from crawlspark.functions import options as O
from crawlspark.operators import links as L
from crawlspark.operators import pageindex as X
from crawlspark.operators import tolerant as T

OPTS = "-umin 12 -umax 30 -amin 3 -amax 6"


def codes(spark, rows, **kw):
    df = spark.createDataFrame([(i, u, a, i == 7) for i, (u, a) in enumerate(rows)], "i int, to_url string, anchor string, known boolean")
    out = L.outlink_codes(df.withColumn("opts", O.parse_options(F.lit(OPTS))), F.col("opts"), known=F.col("known"), **kw)
    return [r.code for r in out.orderBy("i").collect()]


def test_outlink_codes(spark):
    pad = "http://a.com/"
    rows = [
        ("", "abc"),
        ("http://a.co", "abc"),  # 11
        ("http://a.com", "abc"),  # 12
        (pad + "x" * 17, "abc"),  # 30
        (pad + "x" * 18, "abc"),  # 31
        (pad, "ab"),
        (pad, "abcdef"),
        (pad, "abc"),
        (pad, "abcdefg"),
        ("/relative/path", "abc"),
        (None, "abc"),
        (pad, None),
    ]
    assert codes(spark, rows) == [101, 102, 0, 0, 102, 103, 0, 104, 103, 107, 101, 103]


def test_hard_url_limit_and_extra_rule(spark):
    df = spark.createDataFrame([("http://a.com/" + "x" * 1100, "abcdef"), ("http://a.com/y", "abcdef")], "to_url string, anchor string")
    df = df.withColumn("opts", O.parse_options(F.lit("-umax 5000")))
    out = L.outlink_codes(df, F.col("opts"), extra=lambda url, anchor: F.when(url.endswith("y"), 900).otherwise(0))
    assert [r.code for r in out.collect()] == [102, 900]


def test_external_links(spark):
    rows = [("http://a.com/", "http://a.com/x"), ("http://a.com/", "http://b.com/x")]
    df = spark.createDataFrame([(*r, "abcdef") for r in rows], "url string, to_url string, anchor string")
    assert [r.internal for r in L.mark_same_host(df, "url", "to_url").collect()] == [True, False]
    df = df.withColumns({"s": F.lit("a.com"), "opts": O.default_options()})
    out = L.outlink_codes(df, F.col("opts"), source_group="s", ignore_external=True)
    assert [r.code for r in out.collect()] == [0, 108]


def test_link_codes(spark):
    line = "-amin 2 -amax 4 -umin 13 -umax 20 -upre http:// -upos z -ucon m/ -ureg .*/[a-z]+"
    rows = [
        ("http://a.com/z", "a", 100), ("http://a.com/z", "abcde", 100), ("http://a.c/z", "ab", 200),
        ("http://a.com/" + "z" * 8, "ab", 200), ("https://a.com/z", "ab", 210), ("http://a.com/x", "ab", 211),
        ("http://a.org/zz", "ab", 212), ("http://a.com/9z", "ab", 213), ("http://a.com/z", "abcd", 0), ("http://a.com/" + "z" * 7, "ab", 0),
    ]
    df = spark.createDataFrame(rows, "to_url string, anchor string, want int").withColumn("opts", O.parse_options(F.lit(line)))
    for r in L.link_codes(df, F.col("opts")).collect():
        assert r.code == r.want, r
    empty = df.withColumn("opts", O.parse_options(F.lit("")))
    assert {r.code for r in L.link_codes(empty, F.col("opts"), anchor=None).collect()} == {0}


def links_of(spark, html, tolerant):
    pages = spark.createDataFrame([(1, "http://a.com/b/c", html)], "id int, url string, html string")
    df = T.extract_outlinks_tolerant(pages, "id") if tolerant else L.extract_outlinks(pages, ["id"])
    return [(r.tag, r.to_url, r.anchor) for r in df.orderBy("tag_pos").collect()]


@pytest.mark.parametrize("tolerant", [False, True])
def test_follow_rules(spark, tolerant):
    html = (
        '<a href="/1" rel="nofollow">x</a><a href="/2" rel="NoFollow">x</a><a href="/3" rel="nofollow external">three</a>'
        '<a name="n">no target</a><form action="/f"><b>y</b></form><img src="i.png"><script src=s.js>var a="<a href=/no>";</script>'
        '<link href="//h/css"><iframe src="/if"></iframe><area href="#top"><a href="javascript:go()">j</a>'
        '<!-- <a href="/c">c</a> --><a class="a > b" href="/4">  four <b>bold</b>\n</a><a HREF=\'/5\'>five &amp; six</a>'
    )
    base = "http://a.com"
    want = [
        ("a", base + "/3", "three"), ("img", base + "/b/i.png", ""), ("script", base + "/b/s.js", ""), ("link", "http://h/css", ""),
        ("iframe", base + "/if", ""), ("area", base + "/b/c#top", ""), ("a", base + "/4", "four bold"), ("a", base + "/5", "five & six"),
    ]
    got = links_of(spark, html, tolerant)
    assert got == want


def test_post_forms_and_asked_for_forms(spark):
    html = '<form action="/g">go</form><form action="/p" method="POST">go</form>'
    pages = spark.createDataFrame([(1, "http://a.com/", html)], "id int, url string, html string")
    got = L.extract_outlinks(pages, ["id"], ignore_tags=("none",)).collect()
    assert [r.to_url for r in got] == ["http://a.com/g"]


def test_quoted_ends_and_forms(spark):
    html = '<a data-x="1 > 0" href="/y">hello link</a><p title="a>b">para</p><a title=it\'s href=/z>one</a><p>it\'s</p>'
    assert links_of(spark, html, False) == [("a", "http://a.com/y", "hello link"), ("a", "http://a.com/z", "one")]
    form = '<form action="/f">go <a href=/1>one</a> mid <a href=/2>two</a> end</form><form action=/g>all</form><a href=/3>x</a>'
    pages = spark.createDataFrame([(1, "http://a.com/", form)], "id int, url string, html string")
    got = {(r.to_url, r.anchor) for r in L.extract_outlinks(pages, ["id"], ignore_tags=("none",)).collect()}
    assert got == {("http://a.com/f", "go one mid"), ("http://a.com/1", "one"), ("http://a.com/2", "two"), ("http://a.com/g", "all"), ("http://a.com/3", "x")}


def test_links_follow_the_base_href(spark):
    html = '<head><base href="http://other.com/d/"></head><body><a href="k?a=1&copy=2&amp;b">x</a></body>'
    assert links_of(spark, html, False) == [("a", "http://other.com/d/k?a=1&copy=2&b", "x")]
    pages = spark.createDataFrame([(1, True, "http://a.com/b/c", html)], "id int, is_seed boolean, url string, html string")
    assert [r.to_url for r in L.seed_anchors(pages, ["id"]).collect()] == ["http://other.com/d/k?a=1&copy=2&b"]


@pytest.mark.parametrize("tolerant", [False, True])
def test_empty_links(spark, tolerant):
    html = '<a href=x></a><p></p><a href=a> <a href=y>t</a></a><a href=z> </a><a href=w><img src=q></a>'
    got = [u for t, u, _ in links_of(spark, html, tolerant) if t == "a"]
    assert got == ["http://a.com/b/" + n for n in "yzw"]


def test_tolerant_markup(spark):
    html = "<A HREF=/u>up<p>open<a href='/v'>v &eacute;<script>document.write('<a href=/no>')</script></a><a href=/w>w"
    assert links_of(spark, html, True) == [
        ("a", "http://a.com/u", "up open"), ("a", "http://a.com/v", "v é"), ("a", "http://a.com/w", "w"),
    ]


def test_tolerant_tier_agrees_on_regular_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    cols = ["page_id", "tag_pos", "to_url", "anchor"]
    one = L.extract_outlinks(pages, ["page_id"]).select(*cols).collect()
    two = T.extract_outlinks_tolerant(pages, "page_id").select(*cols).collect()
    assert sorted(one) == sorted(two) and one


def test_raw_hrefs_fail_without_resolution(spark):
    pages = spark.createDataFrame([(1, "http://a.com/", '<a href="/some/path">anchor</a>', True)], "id int, url string, html string, is_seed boolean")
    raw = L.outlink_codes(L.seed_anchors(pages, ["id"], resolve=False), O.default_options())
    assert [r.code for r in raw.collect()] == [107]
    assert [r.code for r in L.outlink_codes(L.seed_anchors(pages, ["id"]), O.default_options()).collect()] == [0]


def test_known_links(spark):
    links = spark.createDataFrame([(1, "u"), (1, "v"), (2, "u")], "id int, to_url string")
    old = spark.createDataFrame([(1, "u"), (1, "u")], "id int, to_url string")
    assert sorted((r.id, r.to_url, r.known) for r in L.mark_known(links, old, ["id"]).collect()) == [(1, "u", True), (1, "v", False), (2, "u", False)]
    assert L.new_outlinks(links, old, ["id"]).count() == 2


def test_insert_absent(spark):
    table = spark.createDataFrame([("a", 1), ("b", 1)], "key string, v int")
    rows = spark.createDataFrame([("b", 2), ("c", 2)], "key string, v int")
    assert sorted(map(tuple, L.insert_absent(table, rows).collect())) == [("a", 1), ("b", 1), ("c", 2)]
    assert sorted(map(tuple, L.insert_absent(table, rows, overwrite=True).collect())) == [("a", 1), ("b", 2), ("c", 2)]


def test_extract_links_can_ignore_external_ones(spark):
    from crawlspark.operators.domains import DOMAIN
    from crawlspark.plans.jobs import extract_links

    html = '<a href="/in/page">internal</a><a href="http://b.a.com/x">sibling</a><a href="http://other.com/x">external</a>'
    pages = spark.createDataFrame([(1, "http://www.a.com/", html)], "id int, url string, html string")
    suffixes = spark.createDataFrame([("com",)], "domain string")

    def codes_of(**kw):
        return [r.code for r in extract_links(pages, ["id"], **kw).orderBy("tag_pos").collect()]

    assert codes_of() == [0, 0, 0]
    assert codes_of(ignore_external=True) == [0, 108, 108]
    assert codes_of(ignore_external=True, mode=DOMAIN, suffixes=suffixes) == [0, 0, 108]


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 3])
def test_index_lists(spark, rows_per_bucket):
    old = spark.createDataFrame([("p", u, i) for i, u in enumerate("abcdc")], "page string, to_url string, pos int")
    new = spark.createDataFrame([("p", u, i) for i, u in enumerate("xbxy")], "page string, to_url string, pos int")

    def text(df):
        return "".join(r.to_url for r in df.orderBy("pos").collect())

    added = X.add_links(old, new, rows_per_bucket)
    assert text(added) == "xbyacd" and [r.pos for r in added.orderBy("pos").collect()] == list(range(6))
    assert text(X.remove_links(old, new, rows_per_bucket)) == "acd"
    assert text(X.cap_links(added, 5, 4)) == "xbya" and text(X.cap_links(added, 6, 4)) == "xbyacd"
    assert text(X.put_first(added, "p", "n")) == "nxbyacd"
