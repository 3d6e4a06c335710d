"""Entity and collection fields: CSS paths against a matcher that looks at the whole tree, literal pages, defined cases."""

import random

from pyspark.sql import functions as F

from crawlspark.functions.options import field_extractors, parse_options
from crawlspark.functions.selectors import chains
from crawlspark.operators.entities import BLOCKS, page_entities, with_entities


class Node:
    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.inner = tag, attrs, parent, []

    def kids(self):
        return [x for x in self.inner if isinstance(x, Node)]

    def walk(self):
        for kid in self.kids():
            yield kid
            yield from kid.walk()

    def html(self):
        attrs = "".join(f' {k}="{v}"' for k, v in self.attrs.items())
        return f"<{self.tag}{attrs}>" + "".join(x if isinstance(x, str) else x.html() for x in self.inner) + f"</{self.tag}>"

    def raw(self):
        return "".join(x if isinstance(x, str) else (f" {x.raw()} " if x.tag in BLOCKS else x.raw()) for x in self.inner)


def grow(rng, tag="body", parent=None, depth=0):
    attrs = {}
    if rng.random() < 0.6:
        attrs["class"] = " ".join(rng.sample(["x", "y", "z"], rng.randint(1, 2)))
    if rng.random() < 0.3:
        attrs["id"] = rng.choice("pq")
    node = Node(tag, attrs, parent)
    for _ in range(rng.randint(0, 4) if depth < 5 else 0):
        node.inner.append(f"{rng.randint(0, 99)}{rng.choice(['', ' '])}")
        node.inner.append(grow(rng, rng.choice(["div", "span", "b", "section"]), node, depth + 1))
    return node


def is_compound(node, compound):
    """Compounds of the test's own form: (tag, class, id, nth child, first of type)."""
    tag, cls, name, nth, first = compound
    kids = node.parent.kids() if node.parent else [node]
    return (
        (tag in (None, node.tag))
        and (cls is None or cls in node.attrs.get("class", "").split())
        and (name is None or node.attrs.get("id") == name)
        and (nth is None or kids.index(node) + 1 == nth)
        and (not first or [k for k in kids if k.tag == node.tag][0] is node)
    )


def is_found(node, path):
    """Right to left over the whole tree."""
    *before, (combinator, compound) = path
    if not is_compound(node, compound):
        return False
    if not before:
        return True
    older = []
    if node.parent and combinator in ">":
        older = [node.parent]
    elif combinator == " ":
        up = node.parent
        while up:
            older.append(up)
            up = up.parent
    elif node.parent:
        kids = node.parent.kids()
        older = kids[: kids.index(node)]
        older = older[-1:] if combinator == "+" else older
    return any(is_found(o, before) for o in older)


def random_path(rng):
    path = []
    for _ in range(rng.randint(1, 3)):
        tag = rng.choice([None, "div", "span", "b", "section"])
        cls, name = rng.choice([None, "x", "y", "z"]), rng.choice([None] * 4 + ["p"])
        path.append((rng.choice(" >+~"), (tag, cls, name, rng.choice([None] * 4 + [1, 2]), rng.random() < 0.15)))
    return path


def written(path):
    out = ""
    for i, (combinator, (tag, cls, name, nth, first)) in enumerate(path):
        part = (tag or "*") + (f".{cls}" if cls else "") + (f"#{name}" if name else "")
        part += (f":nth-child({nth})" if nth else "") + (":first-of-type" if first else "")
        out += (f" {combinator} " if i and combinator != " " else " " if i else "") + part
    return out


def test_paths_against_whole_tree():
    rng = random.Random(5)
    hits = 0
    for _ in range(300):
        page = Node("html", {}, None)
        body = grow(rng, parent=page)
        page.inner = [Node("head", {}, page), body]
        html = page.html()
        paths = [random_path(rng) for _ in range(6)]
        expected = []
        for i, path in enumerate(paths):
            node = next((n for n in body.walk() if is_found(n, path)), None)
            if node is not None:
                expected.append({"item": 0, "field": str(i), "value": " ".join(node.raw().split())})
        assert page_entities(html, {str(i): written(p) for i, p in enumerate(paths)}, {}) == expected
        hits += len(expected)
    assert hits > 300


def values(html, path):
    return [e["value"] for e in page_entities(html, {"f": path}, {})]


def test_paths():
    page = '<meta name="a" content="m &amp; n"><body><p id=i class="k l">o<b>ne</b> <p lang=en-GB>two<ul><li>x<li>y<ul><li>z</ul><li>w</ul>'
    assert values(page, "#i") == ["one"] and values(page, ".l.k") == ["one"] and values(page, "p + p") == ["two"]
    assert values(page, "[lang|=en]") == ["two"] and values(page, "[lang$='GB']") == ["two"] and values(page, "[lang^='']") == []
    assert values(page, "ul > li:nth-child(2)") == ["y z"] and values(page, "li li") == ["z"] and values(page, "ul>li:nth-of-type(2n+3)") == ["w"]
    assert values(page, "h1, p ~ ul") == ["x y z w"] and values(page, "li:nth-child(even)") == ["y z"] and values(page, "P") == ["one"]
    assert values(page, "body > p") == ["one"] and values(page, "html p") == []
    assert values(page, "meta") == []  # the root is the body
    head = f"<html><head>{page}"
    assert page_entities(head, {"f": "[name=a]"}, {}, root="head") == [{"item": 0, "field": "f", "value": "m & n"}]
    for bad in ("", " ", ">", "a >", "a,,b", "a:last-child", "[", "a:nth-child(x)", "1a", "a b:not(c)", None):
        assert chains(bad) is None and values(page, bad) == [], bad


def test_roots_items_and_defined_cases():
    page = "<div class=r><h1>T</h1><i>1</i></div><table><tr><td>a<td><i>b</i><tr><td>c</table><i>2<script>no</script><style>no</style></i><u></u>"
    assert page_entities(page, {"h": "h1", "i": "i", "u": "u"}, {}, root=".r") == [
        {"item": 0, "field": "h", "value": "T"},
        {"item": 0, "field": "i", "value": "1"},
    ]
    assert values(page, "table ~ i") == ["2"] and values(page, "u") == [""]
    items = page_entities(page, {"h": "h1"}, {"first": "td", "i": "i"}, group="table", item="tr")
    assert [(e["item"], e["field"], e["value"]) for e in items] == [(0, "h", "T"), (1, "first", "a"), (1, "i", "b"), (2, "first", "c")]
    assert page_entities(page, {}, {"x": "td"}) == [] and page_entities(page, {}, {"x": "td"}, item="no") == []
    assert page_entities(None, {"a": "b"}, {}) == page_entities("", {"a": "b"}, {}) == page_entities(page, {}, {}) == []
    nested = page_entities("<div>o<b>1</b><div><b>2</b></div></div>", {}, {"b": "b"}, item="div")
    assert [(e["item"], e["value"]) for e in nested] == [(1, "1"), (2, "2")]


def test_deep_and_long_pages():
    deep = "<p><object>" + "<div>" * 20_000 + "<b>x</b>"
    assert values(deep, "div b") == ["x"]
    assert values("<p>" * 20_000 + "<b>y", "p > b") == ["y"]
    assert len(values("<section>" + "word <i>w</i> " * 50_000 + "</section>", "section")[0].split()) == 100_000


def test_column(spark):
    rows = [(1, "<h1>A</h1>", "-Fh=h1", 7), (1, "<h1>A</h1>", "-Fh=h1", 7), (2, None, "-Fh=h1", None), (3, "<h1>B</h1>", None, 9), (4, "<i>", "-Fh=h1", 0)]
    pages = spark.createDataFrame(rows, "id int, html string, args string, `odd.name` int")
    paths = pages.withColumns({"opts": parse_options(F.col("args"))} | {n: field_extractors(F.col("args"), f) for n, f in (("fields", "F"), ("sub_fields", "FF"))})
    found = with_entities(paths)
    assert found.columns == [*paths.columns, "entities"]
    one = [(0, "h", "A")]
    assert sorted((r["id"], [tuple(e) for e in r["entities"]], r["odd.name"]) for r in found.collect()) == [
        (1, one, 7), (1, one, 7), (2, [], None), (3, [], 9), (4, [], 0)
    ]
    assert with_entities(paths.limit(0)).count() == 0
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
