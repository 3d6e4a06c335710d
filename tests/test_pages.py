import pytest
from pyspark.sql import functions as F

from crawlspark.functions import charsets as C
from crawlspark.functions import html as H
from crawlspark.operators import pages as P
from crawlspark.operators import tolerant as T

X = F.col("x")


def page(spark, html, url="http://a.com/b/c"):
    return spark.createDataFrame([(1, url, html)], "id int, url string, html string")


def test_entities(ask):
    texts = ["a&amp;amp;b", "&lt;p&gt; &quot;x&quot; &eacute;&#233;&#xE9;", "&nope; & &", "&#128512;&#0;&#xD800;", "plain", None, "&copy"]
    assert ask(texts, H.decode_entities(X)) == ["a&amp;b", '<p> "x" ééé', "&nope; & &", "😀��", "plain", None, "©"]


@pytest.mark.parametrize("tolerant", [False, True])
def test_text_and_title(spark, tolerant):
    html = (
        "<html><head><title> My\n <!-- x -->Title &amp; more</title><style>p{}</style></head><body>"
        "<script>if (a<b) '</p>'</script>One<!-- two --> <b>three</b>\n\tfour<P>five&nbsp;</P></body></html>"
    )
    df = page(spark, html)
    if tolerant:
        row = T.page_text_tolerant(df, "id").first()
    else:
        row = P.page_title(P.page_text(df)).first()
    assert row.title == "My Title & more"
    assert row.text == "My Title & more One three four five "


def test_title_must_be_in_the_head(spark):
    assert P.page_title(page(spark, "<html><body><title>no</title>")).first().title == ""
    assert P.page_title(page(spark, "no markup")).first().title == ""


def test_metadata(spark):
    html = (
        "<head><title>T</title><meta name=Keywords content='a, b'><META NAME=\"description\" CONTENT=\"d &amp; e\">"
        "<meta name='keywords' content='last'></head><body><meta name=description content=no>"
    )
    row = P.page_metadata(page(spark, html)).first()
    assert (row.meta_title, row.meta_keywords, row.meta_description) == ("T", "last", "d & e")
    assert P.page_metadata(page(spark, "<head></head>")).first()[3:] == (None, None, None)
    tags = {(r.kind, r.name): r.content for r in P.meta_tags(page(spark, html), ["id"]).collect()}
    assert tags == {("name", "keywords"): "last", ("name", "description"): "d & e"}


REFRESH = [
    ("5", 5, "http://a.com/b/c"), ("5;http://x/", 5, "http://x/"), ("5; url=rel", 5, "http://a.com/b/rel"), ("abc; url=x", None, None),
    ("5; URL=http://y/z", 5, "http://y/z"), (" 5", None, None), ("5;url=bad:x", 5, "http://a.com/b/c"),
]


@pytest.mark.parametrize("content,time,href", REFRESH)
def test_refresh(spark, content, time, href):
    row = P.robots_meta(page(spark, f'<head><meta http-equiv="Refresh" content="{content}"></head>')).first()
    assert (row.refresh_time, row.refresh_href) == (time, href)


ROBOTS = [
    ("none", True, True, False), ("noindex", True, False, False), ("NOFOLLOW", False, True, False), ("noarchive", False, False, True),
    ("all", False, False, False), ("noindex, nofollow", True, True, False),
]


@pytest.mark.parametrize("content,no_index,no_follow,no_cache", ROBOTS)
def test_robots(spark, content, no_index, no_follow, no_cache):
    row = P.robots_meta(page(spark, f"<head><meta name='ROBOTS' content='{content}'></head>")).first()
    assert (row.no_index, row.no_follow, row.no_cache) == (no_index, no_follow, no_cache)


def test_robots_below_body_is_ignored(spark):
    html = '<head><meta http-equiv=pragma content="No-Cache"></head><body><meta name="robots" content="noindex"></body>'
    row = P.robots_meta(page(spark, html)).first()
    assert (row.no_index, row.no_cache) == (False, True)
    assert P.indexable(P.robots_meta(page(spark, html))).count() == 1


def test_base_href(spark):
    html = "<head><base href='/r/'><base href='http://b.com/x/'><base href='http://c.com/'></head>"
    assert P.base_href(page(spark, html)).first().base_url == "http://b.com/x/"
    assert P.base_href(page(spark, html), relative=True).first().base_url == "http://c.com/"
    assert P.base_href(page(spark, "<head></head><body><base href='http://b.com/'>")).first().base_url == "http://a.com/b/c"


CHARSETS = [
    (b"<meta http-equiv='Content-Type' content='text/html; charset=EUC-KR'>", None, "x-windows-949"),
    (b'<meta http-equiv="content-type" content="text/html; charset=gbk">', None, "gbk"),
    (b'<meta charset="utf-8">', None, "utf-8"),
    (b"\xef\xbb\xbfx", None, "utf-8"),
    (b"\xff\xfex", None, "utf-16le"),
    (b"\xfe\xffx", None, "utf-16be"),
    (b"", "text/html; charset=Shift_JIS", "shift_jis"),
    (b"", 'text/html; charset="iso-8859-1"; x=y', "windows-1252"),
    (b'<meta charset="utf-8">', "text/html; charset=big5", "big5"),
    (b'<meta charset="utf-8">', "text/html; charset=nonsense", "utf-8"),
    (b"\xef\xbb\xbf<meta charset=nonsense>", None, "windows-1252"),
    (b" " * 2000 + b'<meta charset="utf-8">', None, "utf-8"),
    (b"<title>x</title><!-- <meta charset=gbk> --><META Content='text/html;charset=KOI8-R' HTTP-EQUIV=content-type>", None, "koi8-r"),
    (b"<meta name=description content='charset=gbk'><body><meta charset=gbk>", None, "windows-1252"),
    (b"", None, "windows-1252"),
]


def test_charsets(spark):
    rows = [(i, bytearray(c), h) for i, (c, h, _) in enumerate(CHARSETS)]
    df = spark.createDataFrame(rows, "i int, content binary, header string")
    got = {r.i: r.charset for r in P.charset_resolution(df, F.col("content"), F.col("header")).collect()}
    assert [got[i] for i in range(len(CHARSETS))] == [want for *_, want in CHARSETS]
    clash = [r.i for r in P.charset_disagreement(df, F.col("content"), F.col("header")).collect()]
    assert clash == [8]


def test_decoding(spark):
    rows = [
        ("utf-8", "é日".encode(), "é日"), ("utf-8", b"\xef\xbb\xbfa\xff", "a\ufffd"), ("windows-1252", b"\x80\xe9", "€é"), ("gbk", "日本".encode("gbk"), "日本"),
        ("windows-1251", "Привет %41+b".encode("cp1251"), "Привет %41+b"), ("utf-16le", b"\xff\xfe" + "x".encode("utf-16-le"), "x"), (None, b"a", None), ("utf-8", None, None),
    ]
    df = spark.createDataFrame([(i, c, None if b is None else bytearray(b)) for i, (c, b, _) in enumerate(rows)], "i int, charset string, content binary")
    got = P.decoded(df, F.col("content"), F.col("charset")).orderBy("i").collect()
    assert [r.html for r in got] == [t for *_, t in rows]


MIMES = [
    ("text/html; charset=x", "http://a/b.pdf", b"", "text/html"),
    ("application/octet-stream", "http://a/b.pdf?q=1", b"", "application/pdf"),
    ("weird/type", "http://a/b.JSON#f", b"", "application/json"),
    (None, "http://a/b", b"", "application/octet-stream"),
    ("text/plain", "http://a/b.txt", b"  <!DOCTYPE html>", "text/html"),
    ("text/plain", "http://a/b.txt", b" " * 70 + b"<html>", "text/html"),
    (None, "http://a/b", b"\xef\xbb\xbf<!DOCTYPE html>", "text/html"),
    (None, "http://a/b", b"<!-- a -->\n<!-- <rss> --><html>", "text/html"),
    ("text/html", "http://a/b", b"%PDF-1.4", "application/pdf"),
    ("text/html", "http://a/b", b"PK\x03\x04zz", "application/zip"),
    ("application/json", "http://a.com", b"just words", "application/json"),
    (None, "http://a.com", None, "application/octet-stream"),
]


def test_mimes(spark):
    rows = [(i, d, u, None if c is None else bytearray(c)) for i, (d, u, c, _) in enumerate(MIMES)]
    df = spark.createDataFrame(rows, "i int, declared string, url string, content binary")
    got = P.mime_resolution(df, F.col("declared"), F.col("url"), F.col("content")).orderBy("i").collect()
    assert [r.mime for r in got] == [want for *_, want in MIMES]


def test_main_content(spark):
    row = P.main_content(page(spark, "<head><title>T</title></head><body><nav>n</nav><article><p>one</p><p>two</p></article>")).first()
    assert (row.content_title, row.content_text, row.content_text_length) == ("T", "one two", 7)
    nested = "<article>one <article>inner</article> tail</article><p>no</p><article>second</article>"
    assert P.main_content(page(spark, nested)).first().content_text == "one inner tail second"
    words = " ".join(f"w{i}" for i in range(20))
    html = f"<head><title>T</title></head><body><nav><p><a href=x>{words}</a></nav><h1>Head</h1><p>{words}<p>short<li><a href=x>{words}</a><div>{words} <a>l</a></div>"
    row = P.main_content(page(spark, html)).first()
    assert (row.content_title, row.content_text) == ("Head", f"{words} {words} l")
    assert P.main_content(page(spark, "<body class=x><p>few words</p></body>")).first().content_text == "few words"
    assert P.main_content(page(spark, None)).first().content_text is None


def test_page_times(spark):
    html = "<head><meta property='article:published_time' content='2024-01-02'><meta name=keywords content=' a, b'></head><time datetime='2023'>x</time>"
    row = P.page_times(page(spark, html)).first()
    assert (row.publish_time, row.modified_time, row.page_category) == ("2024-01-02", None, "a")
    row = P.page_times(page(spark, "<body><!-- <time datetime=1> --><time class=a datetime='2023-05-06'>x</time>")).first()
    assert (row.publish_time, row.page_category) == ("2023-05-06", None)


BROKEN = [
    ('<p>a</p><script>var x=1;', "a"), ("a<!-- b", "a"), ('<a data-x="1 > 0" href="/y">hello</a><p title="a>b">para</p>', "hello para"),
    ("a<style>b</style>c<p", "a c"), ("x <b class='", "x"), ("1 < 2 <3", "1 < 2 <3"), ("it's <p title=it's>b</p> 'c'", "it's b 'c'"),
]


@pytest.mark.parametrize("html,text", BROKEN)
def test_text_of_broken_markup(spark, html, text):
    assert P.page_text(page(spark, html)).first().text == text


REFERENCES = [
    "&amp b", "&copy 2020", "&notit;", "&amp;lt;", "&AMP;x", "&#0000000065;", "&#x00000041;", "&#128;", "&#0;", "&#xD800;", "&#99999999;", "&apos;", "&check;", "&nosuch;",
    "&ampamp;", "a&b", "&", "&#;", "&NotEqualTilde;", "&#38;lt;", "&#65", "&lt;&gt", "&Aacute", "&eacutex",
]


def test_references(ask):
    from html import unescape

    from crawlspark.functions.html import decode_entities

    assert ask(REFERENCES, decode_entities(X)) == [unescape(r) for r in REFERENCES]
    assert ask(["?a=1&copy=2&amp;b&lt", "&copyx", "&copy;x", "&#65x"], decode_entities(X, attribute=True)) == ["?a=1&copy=2&b<", "&copyx", "©x", "Ax"]


def test_head_behind_a_commented_body(spark):
    html = '<head><!-- <body> --><title>T</title><meta name="robots" content="noindex"></head><body><title>no</title></body>'
    assert P.page_title(page(spark, html)).first().title == "T" and P.robots_meta(page(spark, html)).first().no_index
    html = '<head><script>document.write("<body>")</script><title>S</title></head><body>'
    assert P.page_title(page(spark, html)).first().title == "S"


def test_long_refresh(spark):
    html = "<head><meta http-equiv=refresh content='2147483647; url=/x'></head>"
    assert P.robots_meta(page(spark, html)).first().refresh_time == 2147483647


def test_main_content_tolerant(spark):
    words = " ".join(f"w{i}" for i in range(20))
    html = f"<title>T</title><nav><p>{words}</p></nav><h1>Head</h1><p>{words}<p>short<li><a href=x>{words}</a><div>{words} <a>l</a></div>"
    row = T.main_content_tolerant(page(spark, html), "id").first()
    assert row.content_title == "Head" and row.content_text == f"{words}\n{words} l"


def test_own_parser(spark):
    from crawlspark.plans.jobs import extract_pages

    def shout(pages):
        return pages.withColumns({"title": F.lit("mine"), "text": F.upper("html")})

    row = extract_pages(page(spark, "<html><head><title>t</title></head>"), parser=shout).first()
    assert (row.title, row.text, row.meta_title, row.mime) == ("mine", "<HTML><HEAD><TITLE>T</TITLE></HEAD>", "t", "text/html")
