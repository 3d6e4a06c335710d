"""Main text of web pages by tree scoring.

A page is read into a light tree of its elements. Every paragraph earns points for its length and its commas and
passes them to its ancestors, less with each level; an ancestor's sum is discounted by the share of its text
that is in links. The best container is kept, with those siblings that look like more of the same.

Parts that are no article by their element, role or class (menus, page headers, footers, sidebars, notices, adverts, forms, comments,
scripts, hidden parts) are left out before scoring, unless they hold the page's main element or heading, as wrappers do (a form only if it holds all first headings; its
labels, buttons and fields go); lists and boxes that are
mostly links are left out of what is kept.

Defined cases: a null, empty or markup-only page gives the empty text; unclosed quotes, elements, comments and scripts end
with the tag or the page; equal rows give equal results; pages are read whole, whatever their length or depth; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from crawlspark.llm.common import rows_of, table

#: a comment, a tag (quotes count after an equals sign, where they hide a ">"), or other markup
TAG = re.compile(
    r"<(?:!--.*?(?:--!?>|\Z)|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)"
    r"|[!?/][^>]*+(?:>|\Z))",
    re.S,
)
ATTRIBUTE = re.compile(r"""(?i)(?<![\w-])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORD = re.compile(r"[a-z]+")

RAW = set("script style title textarea noembed noframes iframe xmp".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math q rp rt ruby s samp small span strike strong sub sup svg time tt u var wbr".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = HEADINGS | set("p pre li td th dd dt blockquote figcaption caption summary".split())
#: elements that end an open paragraph
CLOSES_P = HEADINGS | set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form header hgroup hr main menu nav ol p pre section summary table ul".split()
)
#: open elements that a start tag ends, up to a boundary
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
NO_ARTICLE = set(
    "head nav menu aside footer form label legend button select dialog noscript template object canvas svg audio video fieldset datalist map applet".split()
)
#: those of them that older pages wrap around everything, the first heading included
WRAPPERS = {"form", "fieldset"}
NO_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
NO_WORDS = set(
    "ad ads adsense advert advertisement alert alerts announcement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer"
    " disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo promotion"
    " recommendations recommended related remark remarks reply replies respond share sharing sidebar social sponsor sponsored subscribe subscription"
    " teaser toolbar topbar widget widgets".split()
)
COMMENTS = set("comment comments disqus reply replies respond remark".split())
GOOD = set("article articlebody body content entry main page post story text blog".split())
BONUS = {"article": 25, "main": 15, "div": 5, "section": 5, "pre": 3, "td": 3, "blockquote": 3, "ol": -3, "ul": -3, "dl": -3, "li": -3}
HEADING_BONUS, GOOD_BONUS = -5, 25
LIST_LIKE = set("ul ol dl div section table".split())


class Page:
    """Elements in page order (parents before children) and the runs of text with their element."""

    def __init__(self, html: str):
        self.tag, self.parent, self.words, self.hidden = ["#page"], [-1], [set()], [False]
        self.text: list[tuple[int, str] | None] = []  # None: a block begins or ends
        stack, at = [0], 0
        count = {}
        while True:
            found = TAG.search(html, at)
            if found is None:
                self._add(stack[-1], html[at:])
                break
            self._add(stack[-1], html[at : found.start()])
            at = found.end()
            name = (found["name"] or "").lower()
            if not name:
                continue
            if name not in INLINE:
                self.text.append(None)
            if found["end"]:
                if count.get(name):
                    while True:
                        top = self.tag[stack.pop()]
                        count[top] -= 1
                        if top == name:
                            break
                continue
            if name in CLOSES_P and count.get("p"):
                self._close(stack, count, {"p"}, {"td", "th", "button", "object", "table"})
            if name in CLOSES:
                self._close(stack, count, *CLOSES[name])
            if name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
                at = close.start() if close else len(html)
                continue
            if name == "br":
                self._add(stack[-1], " ")
            if name in VOID:
                continue
            self.tag.append(name)
            self.parent.append(stack[-1])
            self._attributes(found["attributes"])
            stack.append(len(self.tag) - 1)
            count[name] = count.get(name, 0) + 1

    def _add(self, node: int, text: str) -> None:
        if text:
            self.text.append((node, unescape(text) if "&" in text else text))

    def _close(self, stack: list[int], count: dict[str, int], names: set[str], bounds: set[str]) -> None:
        """Pop through the outermost element of those names that is open inside the bounds."""
        if not any(count.get(n) for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[i]]
            if tag in bounds:
                return
            if tag in names:
                for node in stack[i:]:
                    count[self.tag[node]] -= 1
                del stack[i:]
                return

    def _attributes(self, text: str) -> None:
        words, hidden = set(), False
        if text.strip(" /"):
            for name, value in ATTRIBUTE.findall(text):
                name, value = name.lower(), value.strip("\"'")
                if name in ("class", "id"):
                    # thisIsOne and this-is-one are the same words
                    words.update(WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower()))
                elif name == "role":
                    words.update("role:" + w for w in WORD.findall(value.lower()))
                elif name == "style":
                    hidden |= bool(re.search(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden", value))
                else:
                    hidden |= name == "hidden" or value.lower() == "true"
        self.words.append(words)
        self.hidden.append(hidden)


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = Page(html)
    n, tag, parent, words = len(page.tag), page.tag, page.parent, page.words

    headings = [int(t == "h1") for t in tag]
    for i in range(n - 1, 0, -1):
        headings[parent[i]] += headings[i]
    holds = [0] * n  # bits: 1 an article element is inside, 2 a main element, 4 a first heading
    for i in range(n - 1, 0, -1):
        own = 2 if tag[i] == "main" or "role:main" in words[i] else 1 if tag[i] == "article" else 4 if tag[i] == "h1" else 0
        holds[parent[i]] |= holds[i] | own
    out, in_article = [False] * n, [False] * n
    for i in range(1, n):
        up = parent[i]
        in_article[i] = in_article[up] or tag[i] in ("article", "main")
        # a form around all first headings is the page's own, one with a heading of its own is not
        inside = holds[i] & 3 if tag[i] in WRAPPERS and headings[i] < headings[0] else holds[i]
        out[i] = out[up] or page.hidden[i] or no_article(tag[i], words[i], inside, in_article[up])

    # paragraphs: runs of text within one block
    score, length, linked, links = [0.0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    block = list(range(n))  # the nearest element that is not inline
    for i in range(1, n):
        in_link[i] = in_link[parent[i]] or tag[i] == "a"
        if tag[i] in INLINE:
            block[i] = block[parent[i]]
        if tag[i] == "a" and not out[i]:
            links[block[i]] += 1
    scored = set()
    run: list[tuple[int, str]] = []
    for item in [*page.text, None]:
        if item is not None:
            if not out[item[0]]:
                run.append(item)
            continue
        if not run:
            continue
        size = commas = 0
        for node, text in run:
            k = len("".join(text.split()))
            size += k
            commas += text.count(",") + text.count("，") + text.count("、")
            if in_link[node]:
                linked[block[node]] += k
        node = block[run[0][0]]
        run = []
        if not size:
            continue
        length[node] += size
        if tag[node] in HEADINGS:
            continue
        points = (1 + commas + min(3, size / 100)) * min(1, size / 25)
        up, share = (parent[node] if tag[node] in PARAGRAPHS else node), 1.0
        level = 0
        while up > 0 and share > 0.01:
            score[up] += points * share
            scored.add(up)
            level += 1
            up, share = parent[up], 1 / (2 if level == 1 else 3 * level)
    for i in range(n - 1, 0, -1):
        length[parent[i]] += length[i]
        linked[parent[i]] += linked[i]
        links[parent[i]] += links[i]

    def density(i: int) -> float:
        return linked[i] / length[i] if length[i] else 0.0

    def worth(i: int) -> float:
        bonus = BONUS.get(tag[i], HEADING_BONUS if tag[i] in HEADINGS else 0) + GOOD_BONUS * bool(GOOD & words[i])
        return (score[i] + bonus) * (1 - density(i))

    ranked = {i: worth(i) for i in scored if tag[i] not in ("body", "html") and not out[i]}
    if ranked:
        best = max(sorted(ranked), key=ranked.__getitem__)
        up = best
        while up > 0 and tag[up] != "article":
            up = parent[up]
        best = up or best
    else:
        best = next((i for i in range(n) if tag[i] in ("article", "main", "body") and not out[i]), 0)

    kept = [False] * n
    kept[best] = True
    loose = set()  # runs right below the parent stay out
    if best and tag[best] != "article":
        least = max(10, ranked.get(best, 0) / 5)
        for i in range(1, n):
            if parent[i] == parent[best] and not out[i] and i != best:
                dense = density(i)
                more = ranked.get(i, 0) >= least or tag[i] == "article"
                prose = tag[i] in PARAGRAPHS and (dense < 0.25 if length[i] > 80 else dense == 0 and length[i])
                kept[i] = bool(more or prose)
    for i in range(1, n):
        if kept[parent[i]] and parent[i] not in loose:
            kept[i] = True
        if kept[i] and (out[i] or (i != best and tag[i] in LIST_LIKE and links[i] >= 3 and density(i) > 0.5)):
            kept[i] = False

    blocks: list[str] = []
    line: list[str] = []
    for item in [*page.text, None]:
        if item is None:
            if line:
                blocks += "".join(line).split()
                line = []
        elif kept[item[0]]:
            line.append(item[1])
    return " ".join(blocks)


def no_article(tag: str, words: set[str], holds: int, inside: bool) -> bool:
    """Whether an element is left out, given what it holds and whether an article holds it."""
    if tag in ("html", "body", "article", "main", "#page"):
        return tag == "article" and bool(words & COMMENTS)
    if tag == "head":
        return True
    if tag in WRAPPERS:
        return not holds & 7
    if tag in NO_ARTICLE or (tag == "header" and not inside) or any("role:" + r in words for r in NO_ROLES):
        return not holds & 3
    if words & COMMENTS:
        return not holds & 6
    if words & NO_WORDS or (words & {"header"} and not inside):
        return not holds and not (tag in PARAGRAPHS and words & GOOD)
    return False


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) as page_id, url, text and n_chars."""

    def run(batches):
        for batch in batches:
            for start, values in rows_of(batch, "html", 256):
                texts = [main_text(v) for v in values]
                ids = [batch.column(c).slice(start, len(values)) for c in ("page_id", "url")]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def op2_extract(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
