from pyspark.sql import functions as F

from crawlspark.functions import urls as U
from crawlspark.operators import domains as N

X = F.col("x")
URLS = [
    "http://www.a.co.uk/x?b=1#t", "nope", "/rel", "http://m.ex.com/a b", "https://u:p@h.com:8080/p;x?y", "http://1.2.3.4/",
    "http://localhost/", "http://com/", "http://a.org./", None, "http://h:abc/", "http://[::1]:80/", "HTTP://Up.COM", "file:/x",
]


def suffixes(spark):
    rows = [("com", "GENERIC"), ("org", "GENERIC"), ("uk", "COUNTRY"), ("co.uk", None)]
    return spark.createDataFrame(rows, "domain string, type string")


def test_host(ask):
    assert ask(URLS, U.url_host(X)) == [
        "www.a.co.uk", "", "", "m.ex.com", "h.com", "1.2.3.4", "localhost", "com", "a.org.", "", "", "[::1]", "Up.COM", "",
    ]


def test_hostname_and_page(ask):
    assert ask(URLS, U.url_hostname(X))[:3] == ["www.a.co.uk", None, None]
    assert ask(URLS, U.url_hostname(X, F.lit("d")))[1] == "d"
    assert ask(URLS, U.url_hostname(X))[12] == "up.com"
    pages = ask(URLS, U.url_page(X))
    assert pages[0] == "http://www.a.co.uk/x#t" and pages[1] is None and pages[12] == "http://up.com"


def test_valid(ask):
    assert ask(URLS, U.is_valid_url(X)) == [True, False, False, True, True, True, True, True, True, False, False, True, True, True]


def test_domain(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "i int, x string")
    got = {r.i: r.domain for r in N.with_domain(df, X, suffixes(spark)).collect()}
    assert [got[i] for i in range(len(URLS))] == [
        "a.co.uk", None, None, "ex.com", "h.com", "1.2.3.4", "localhost", "com", "a.org", None, None, "[::1]", "COM", "",
    ]


def test_longest_suffix_wins_and_big_tables_join_the_same(spark, monkeypatch):
    df = spark.createDataFrame([(u,) for u in URLS], "x string")
    small = N.with_suffix(df, U.url_host(X), suffixes(spark)).select("x", "suffix.domain").collect()
    assert dict(small)["http://www.a.co.uk/x?b=1#t"] == "co.uk"
    monkeypatch.setattr(N, "is_small", lambda rows, size: False)
    salted = N.with_suffix(df, U.url_host(X), suffixes(spark)).select("x", "suffix.domain").collect()
    assert sorted(map(repr, salted)) == sorted(map(repr, small))


def test_ip_group_and_partition_fallback(spark):
    ips = spark.createDataFrame([("a.com", "9.9.9.9"), ("b.com", "9.9.9.9")], "host string, ip string")
    df = spark.createDataFrame([("http://a.com/",), ("http://b.com/x",), ("http://c.com/",), ("bad",)], "x string")
    got = {r.x: r for r in N.with_partition(N.with_group(df, X, N.IP, host_ip=ips), X, 100, N.IP, host_ip=ips).collect()}
    assert got["http://a.com/"].part == got["http://b.com/x"].part
    assert got["http://c.com/"].group_key is None and got["bad"].group_key == ""
    assert all(0 <= r.part < 100 for r in got.values())


def test_labels(ask):
    assert ask(["http://a.b.c/", "http://1.2.3.4/", "http://a.b./"], U.host_labels(X)) == [["a", "b", "c"], ["1.2.3.4"], ["a", "b"]]


def test_resolve(ask):
    base = "http://a.com/b/c.aspx?x=1#r"
    cases = {
        "?p=2": "http://a.com/b/c.aspx?p=2",
        "d": "http://a.com/b/d",
        "../d": "http://a.com/d",
        "./d": "http://a.com/b/d",
        "/d": "http://a.com/d",
        "//h/d": "http://h/d",
        "#f": "http://a.com/b/c.aspx?x=1#f",
        "": base,
        " d ": "http://a.com/b/d",
        "../../d": "http://a.com/../d",
        "x/..": "http://a.com/b/",
        "x/.": "http://a.com/b/x/",
        "d?q=../x": "http://a.com/b/d?q=../x",
        "HTTPS://Z.com/A": "https://Z.com/A",
        "javascript:void(0)": None,
        "mailto:x@y": "mailto:x@y",
        "http:d": "http://a.com/b/d",
        "/a/../b": "http://a.com/a/../b",
        "a:b": None,
        "1:b": "http://a.com/b/1:b",
    }
    got = ask([(base, t) for t in cases], U.resolve(U.base_parts(F.col("b")), F.col("t")), "b string, t string")
    assert dict(zip(cases, got)) == cases
    odd = [("nope", "/x"), ("http://a.com", "d"), ("http://a.com", "?q"), ("http://a.com", ""), ("http://a.com/x", None)]
    got = ask(odd, U.resolve(U.base_parts(F.col("b")), F.col("t")), "b string, t string")
    assert got == [None, "http://a.com/d", "http://a.com/?q", "http://a.com", None]


def test_reverse_key_round_trip(ask):
    urls = ["http://www.a.com:80/x?y#z", "https://h/", "http://a.b.c", "ftp://x.y/p:q", "http://[::1]:80/a", "http://a.com?x=1", "file:/x"]
    keys = ask(urls, U.reverse_key(X))
    assert keys[0] == "com.a.www:http:80/x?y#z"
    assert ask(keys, U.unreverse_key(X)) == urls
    assert ask(["nope"], U.reverse_key(X)) == [None]


def test_idn(ask):
    assert ask(["http://bücher.example/ä", "file:/x", "nope", "http://a.com/b c?q=%41"], U.to_ascii(X)) == [
        "http://xn--bcher-kva.example/ä", "file:/x", None, "http://a.com/b%20c?q=%2541",
    ]
    assert ask(["http://xn--bcher-kva.example:8/", "file:/x", "http://a.com/"], U.to_unicode(X)) == [
        "http://bücher.example:8/", "file:/x", "http://a.com/",
    ]
    assert ask(["http://" + "x" * 70 + ".com/"], U.to_ascii(X)) == [None]


def java_hash(text):
    h = 0
    data = text.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (h * 31 + int.from_bytes(data[i : i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def test_string_hash(ask):
    words = ["", "a", "hello world", "www.example.org", "für", "日本語", "😀x", "z" * 500]
    assert ask(words, U.string_hash(X)) == [java_hash(w) for w in words]
    assert java_hash("hello") == 99162322


def parts(spark, urls, n=100, mode=N.HOST, seed=0):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, x string")
    got = {r.i: r.part for r in N.with_partition(df, X, n, mode, seed, suffixes(spark)).collect()}
    return [got[i] for i in range(len(urls))]


SITES = ["https://shop.lake.com/", "https://cdn.lake.com/a.js", "https://cdn.lake.com/b/c?d", "https://cdn.lake.com", "https://hill.net/x"]


def test_partition_one_reducer(spark):
    assert parts(spark, SITES, 1) == [0] * 5


def test_partition_by_host(spark):
    shop, one, two, three, _ = parts(spark, SITES)
    assert one == two == three != shop


def test_partition_by_domain(spark):
    *lake, hill = parts(spark, SITES, mode=N.DOMAIN)
    assert len(set(lake)) == 1 and hill not in lake


def test_partition_seed_moves_hosts(spark):
    assert parts(spark, SITES[:1], seed=0) != parts(spark, SITES[:1], seed=1)


def test_partition_of_keys_and_scores_agree(spark, ask):
    back = ask(ask(SITES, U.reverse_key(X)), U.unreverse_key(X))
    assert parts(spark, back) == parts(spark, SITES)


def test_partition_range(spark):
    assert all(0 <= p < 50 for p in parts(spark, URLS, 50))


def test_representative(spark):
    # (source, target, temporary, which is chosen): s the source, d the target
    rows = [
        ("no url", "http://m.com/", True, "d"),
        ("http://m.com/", "no url", False, "d"),
        ("http://m.com", "http://n.net", True, "d"),
        ("https://m.com", "https://m.com/start/here.php", False, "s"),
        ("https://m.com/start/here.php", "https://m.com", False, "d"),
        ("https://m.com/2023/old.html", "https://m.com/2024/new.html", False, "d"),
        ("https://m.com", "https://m.com/start/here.php", True, "s"),
        ("https://m.com/start/here.php", "https://m.com", True, "d"),
        ("https://m.com/2023/older.html", "https://m.com/2024/new.html", True, "d"),
        ("https://blog.m.com/2023/post", "https://en.blog.m.com/2023/post", True, "s"),
        ("https://en.blog.m.com/p", "https://blog.m.com/p/q/r", True, "d"),
        ("https://blog.m.com", "https://en.blog.m.com", True, "s"),
        ("http://m.com/u/", "http://m.com/u/v", True, "s"),
        ("http://m.com/uv", "http://m.com/wx", True, "s"),
    ]
    df = spark.createDataFrame(rows, "src string, dst string, temp boolean, want string")
    got = N.choose_representative(df, F.col("src"), F.col("dst"), F.col("temp"), suffixes(spark))
    for r in got.collect():
        assert r.chosen == (r.src if r.want == "s" else r.dst), r
