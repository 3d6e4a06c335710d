"""Main text: the given pages' articles, pages with the parts that must go, broken markup, odd rows."""

import re
from html import unescape

from crawlspark.llm.extract import extract, main_text

WORDS = "some words of prose, which go on for a while, and then end."


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in extract(pages).collect():
        article = re.search(r"(?s)<article>(.*)</article>", html[r["page_id"]])[1]
        want = " ".join(unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", article))).split())
        assert r["text"] == want and r["n_chars"] == len(want)


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


def paragraphs(n, tag="p"):
    return "".join(f"<{tag}>{i} {WORDS}</{tag}>" for i in range(n))


PROSE = " ".join(f"{i} {WORDS}" for i in range(4))
AROUND = [
    "<header><h2>Site</h2><p>All the news, all day, every day, for you.</p></header>",
    "<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>",
    "<aside><p>Aside words, more of them, and more, and more still here.</p></aside>",
    "<div class='sidebar'><p>Sidebar words, more of them, and more, and more.</p></div>",
    "<div id=cookieNotice>We use cookies, as all do, to make things better for you.</div>",
    "<div class='ad-box'><p>Buy now, buy more, buy all of it, today, at once, here.</p></div>",
    "<form><label>Name</label><input><textarea>Words in a box, more words.</textarea><button>Send</button></form>",
    "<section id='comments'><article class=comment><p>I think so, too, and always did, as you know well.</p></article></section>",
    "<div role=banner>Banner words, many of them, with commas, too.</div>",
    "<div style='display: none'><p>Hidden words, more of them, and more of them still.</p></div>",
    "<script>document.write('<p>script, words, here</p>')</script><style>p{}</style><noscript><p>No script, no words, none.</p></noscript>",
    "<!-- <p>comment, words, here</p> --><template><p>Template words, never shown, at all.</p></template>",
    "<footer><p>Footer words, more, and more, and more, and rights reserved.</p></footer>",
]


def test_parts_that_go():
    body = "".join(AROUND)
    for holder in ("article", "main", "div", "div class=post", "td"):
        inside = f"<{holder}>{paragraphs(4)}</{holder.split()[0]}>"
        inside = f"<table><tr>{inside}</table>" if holder == "td" else inside
        assert main_text(page(body + inside + body)) == PROSE
        assert main_text(page(f"<div id=wrapper class='has-sidebar sidebar'><h1 hidden></h1>{body}{inside}{body}</div>")) == PROSE


def test_parts_inside_the_article():
    for part in AROUND[1:]:
        assert main_text(page(f"<article><h1>Title here</h1>{paragraphs(2)}{part}<p>2 {WORDS}<p>3 {WORDS}</article>")) == "Title here " + PROSE
    links = "<ul>" + "".join(f"<li><a href=/{i}>Another page {i}</a></li>" for i in range(5)) + "</ul>"
    assert main_text(page(f"<article>{paragraphs(4)}{links}</article>")) == PROSE


def test_forms_around_the_page():
    fields = "<label>Name</label><input><textarea>Words in a box.</textarea><select><option>One</select><button>Send</button>"
    for form in ("form", "fieldset", "form><fieldset"):
        ends = "".join(f"</{t}>" for t in reversed(form.split("><")))
        whole = f"<{form}>{fields}<div><h1>Title here</h1>{paragraphs(4)}</div>{fields}{ends}"
        assert main_text(page(whole)) == "Title here " + PROSE
        # with a heading outside, the form's own heading does not make it the page
        assert main_text(page(f"<div><h1>Title here</h1>{paragraphs(4)}<{form}><h1>Ask us</h1><p>Words, {WORDS}</p>{fields}{ends}</div>")) == "Title here " + PROSE


def test_siblings_are_kept():
    body = f"<div><div><h1>Title</h1></div><div>{paragraphs(4)}</div><div>{paragraphs(4)}</div><p>More {WORDS} And {WORDS}</p></div>"
    assert main_text(page(body)) == f"Title {PROSE} {PROSE} More {WORDS} And {WORDS}"


def test_text():
    assert main_text(page("<article><p>a&amp b &lt;i&gt;&nbsp;&#65;&copy\n\t c<b>d</b>e<br>f</p>g<p title='x>y' data-y=\"<p>\">h, i</article>")) == "a& b <i> A© c" + "de f g h, i"
    assert main_text("plain words, no markup, but & all of it") == "plain words, no markup, but & all of it"


def test_broken_markup():
    assert main_text("<article><p>one, two<p>three, <b>four<p>five</article") == "one, two three, four five"
    assert main_text(f"<article>{paragraphs(4)}<script>var x = '<p>no</p>';") == PROSE
    assert main_text(f"<article>{paragraphs(4)}<!-- <p>no</p>") == PROSE
    assert main_text(f"<article>{paragraphs(4)}</div></section></article></p></body>") == PROSE
    assert main_text("<div>" * 30000 + paragraphs(4)) == PROSE
    assert main_text(f"<article><a title='unclosed>{paragraphs(4)}").split()[-1] == "end."
    assert main_text(f"<article><p title=it's>it's</p>{paragraphs(4)}</article>") == f"it's {PROSE}"
    assert "words" in main_text("<p>words, " * 20000)


def test_odd_rows(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<br>", "x"), (4, "u", page(""), "x"), (5, "u", page(paragraphs(4)), "x"), (5, "u", page(paragraphs(4)), "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in extract(pages).collect()), key=repr)
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), (None, "u", "", 0), (4, "u", "", 0)] + [(5, "u", PROSE, len(PROSE))] * 2, key=repr)
    assert extract(pages.limit(0)).count() == 0
