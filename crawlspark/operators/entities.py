"""Entity and collection fields of a page by the CSS paths of its seed: ``-ed``/``-F`` and ``-cd``/``-ci``/``-FF`` options.

Each page is walked once for all its paths, in the Arrow batch that holds it, and nothing is shuffled. An element takes over from its parent and
the sibling before which steps of the paths are already met, so a start tag costs the steps of its own name and no look back. Pages
without paths are not read.

An entity field is the text of the first element below the entity's root that its path finds; a collection has an item for every element below
``-cd`` that ``-ci`` finds, and an item's field is the first such element in it, given to the innermost item around it. Paths are those of the
whole page, so they may name the root or what is around it. Text is without scripts and
styles, white space is one blank, blocks are apart; a ``meta``'s text is its content. Defined cases: null or empty markup, null
paths and paths that can't be read give no field; an element without text gives the empty value; what is never closed ends with its
parent or the page; a page without a ``body`` tag has one from its first content on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlspark.functions.selectors import chains

# Elements of HTML without content, of the head, that break lines, and whose end tags may be missing.
VOID = frozenset("area base br col embed frame hr img input link meta source track wbr".split())
HEAD = frozenset("html head title meta link script style base noscript template".split())
BLOCKS = frozenset(
    """address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul""".split()
)
_P_ENDS = BLOCKS - {"br", "body", "caption", "option", "tbody", "td", "tfoot", "th", "thead", "tr"}
_SCOPE = frozenset("button caption html object table td th template".split())
# (elements that are closed, start tags that close them, elements that keep them open)
IMPLIED = (
    (frozenset({"p"}), _P_ENDS, _SCOPE),
    (frozenset({"li"}), frozenset({"li"}), _SCOPE | {"ul", "ol", "menu"}),
    (frozenset({"dt", "dd"}), frozenset({"dt", "dd"}), _SCOPE | {"dl"}),
    (frozenset({"option"}), frozenset({"option", "optgroup"}), frozenset({"select"})),
    (frozenset({"td", "th"}), frozenset({"td", "th", "tr", "tbody", "tfoot"}), frozenset({"table"})),
    (frozenset({"tr"}), frozenset({"tr", "tbody", "tfoot"}), frozenset({"table"})),
    (frozenset({"head"}), frozenset({"body"}), frozenset()),
)

ENTITY = "array<struct<item:int,field:string,value:string>>"


class _Element:
    __slots__ = ("tag", "attrs", "place", "of_type", "met", "above", "near", "children", "kinds", "last", "passed", "item", "takers")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs = tag, attrs
        self.place = self.of_type = 1
        self.met = self.above = self.near = 0  # bits of steps met here, here or further out; open elements of IMPLIED
        self.children, self.kinds = 0, {}
        self.last = self.passed = 0  # bits of steps that the last child, any child met
        self.item = 0
        self.takers: list[list[str]] = []


class _Walk(HTMLParser):
    """All paths of one page: those of its roots, collections and items, and of the fields of both."""

    def __init__(self, roots: tuple, groups: tuple, items: tuple, fields: list[tuple[int, bool, tuple]]) -> None:
        super().__init__(convert_charrefs=True)
        self.found: dict[tuple[int, int], list[str]] = {}  # (item, field): pieces of text
        self.items = 0
        self.steps: dict[str | None, list[tuple]] = {}
        self.bit = 1
        self.roots, self.groups = self._add(roots), self._add(groups)
        self._add(items, (-1, True))
        for number, of_item, alternatives in fields:
            self._add(alternatives, (number, of_item))
        root = _Element("", {})
        self.stack = [root]
        self.open = {"body": 0}

    def _add(self, alternatives: tuple, end: tuple[int, bool] | None = None) -> int:
        """Bits of the chains' last steps."""
        last = 0
        for chain in alternatives:
            before = 0
            for i, step in enumerate(chain):
                done = end if i == len(chain) - 1 else None
                self.steps.setdefault(step.tag, []).append((step.combinator, before, step.tests, self.bit, done))
                before, self.bit = self.bit, self.bit << 1
            last |= before
        return last

    def _pop(self) -> None:
        gone = self.stack.pop()
        self.open[gone.tag] -= 1
        self._mark(gone.tag)

    def _mark(self, tag: str) -> None:
        if tag in BLOCKS:
            for pieces in self.stack[-1].takers:
                pieces.append(" ")

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in HEAD and tag != "body" and not self.open["body"]:
            self._start("body", {})
        elif tag in ("html", "body") and self.open.get(tag):
            return
        first: dict[str, str] = {}
        for name, value in attrs:
            first.setdefault(name, value or "")
        self._start(tag, first)

    def _start(self, tag: str, attrs: dict[str, str]) -> None:
        for i, (names, enders, _) in enumerate(IMPLIED):
            if tag in enders and self.stack[-1].near >> i & 1:
                while self.stack[-1].tag not in names:
                    self._pop()
                self._pop()
        self._mark(tag)
        parent, e = self.stack[-1], _Element(tag, attrs)
        parent.children += 1
        parent.kinds[tag] = parent.kinds.get(tag, 0) + 1
        e.place, e.of_type = parent.children, parent.kinds[tag]
        e.item, e.takers = parent.item, parent.takers
        ends = []
        for kind in (tag, None):
            for combinator, before, tests, bit, end in self.steps.get(kind, ()):
                seen = parent.above if combinator == " " else parent.met if combinator == ">" else parent.last if combinator == "+" else parent.passed
                if (not before or seen & before) and all(test(e) for test in tests):
                    e.met |= bit
                    if end:
                        ends.append(end)
        e.above = parent.above | e.met
        parent.last, parent.passed = e.met, parent.passed | e.met
        for i, (names, _, bounds) in enumerate(IMPLIED):
            e.near |= (tag in names or (tag not in bounds and parent.near >> i & 1)) << i
        fresh = []
        for what, of_item in sorted(set(ends), reverse=True):
            if what >= 0 and (parent.item if of_item else parent.above & self.roots):
                key = (parent.item if of_item else 0, what)
                if key not in self.found:
                    self.found[key] = [attrs.get("content", "")] if tag == "meta" else []
                    fresh.append(self.found[key])
            elif what < 0 and parent.above & self.groups:
                self.items += 1
                e.item = self.items
        if tag in VOID:
            return
        e.takers = e.takers + fresh if fresh else e.takers
        self.stack.append(e)
        self.open[tag] = self.open.get(tag, 0) + 1

    def handle_endtag(self, tag: str) -> None:
        if tag in ("body", "html") or not self.open.get(tag):
            return
        while self.stack[-1].tag != tag:
            self._pop()
        self._pop()

    def handle_data(self, data: str) -> None:
        if self.cdata_elem in ("script", "style"):
            return
        if not self.open["body"] and data.strip() and self.stack[-1].tag in ("", "html", "head"):
            self._start("body", {})
        for pieces in self.stack[-1].takers:
            pieces.append(data)


def page_entities(
    html: str | None, fields: dict[str, str], sub_fields: dict[str, str], root: str | None = None, group: str | None = None, item: str | None = None
) -> list[dict]:
    """(item, field, value) of a page: the entity's fields as item 0, then those of items from 1, both as the fields are named."""
    roots, groups, items = (chains(path) or () for path in (root or "body", group or "body", item))
    asked = [(name, bool(roots), False, path) for name, path in fields.items()]
    asked += [(name, bool(groups and items), True, path) for name, path in sub_fields.items()]
    paths = [(number, of_item, found) for number, (_, ok, of_item, path) in enumerate(asked) if ok and (found := chains(path))]
    if not paths or not html:
        return []
    walk = _Walk(roots, groups, items, paths)
    walk.feed(html)
    walk.close()
    found = [(key, "".join(pieces)) for key, pieces in sorted(walk.found.items())]
    return [{"item": i, "field": asked[f][0], "value": re.sub(r"[ \t\n\x0b\f\r]+", " ", text).strip(" ")} for (i, f), text in found]


def with_entities(
    pages: DataFrame, html: str = "html", opts: str = "opts", fields: str = "fields", sub_fields: str = "sub_fields", out: str = "entities"
) -> DataFrame:
    """``pages`` with ``out``, an array of (item, field, value) by the paths of each page's options."""
    asked = F.struct(
        F.col(html).alias("html"),
        F.map_entries(fields).alias("fields"),
        F.map_entries(sub_fields).alias("sub_fields"),
        *[F.col(f"{opts}.{name}").alias(name) for name in ("entity_dom", "collection_dom", "collection_item")],
    )
    wanted = F.coalesce(F.size(fields), F.lit(0)) + F.coalesce(F.size(sub_fields), F.lit(0)) > 0
    packed = pages.withColumn(out, F.when(wanted & F.col(html).isNotNull(), asked))
    value = T.DataType.fromDDL(ENTITY)
    schema = T.StructType([*pages.drop(out).schema.fields, T.StructField(out, value)])
    kind = pa.list_(pa.struct([("item", pa.int32()), ("field", pa.string()), ("value", pa.string())]))
    kept = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, column = batch.column(0).flatten()
            rows = []
            for i in range(batch.num_rows):
                ask = column[i].as_py()
                maps = [{e["key"]: e["value"] for e in ask[name] or []} if ask else {} for name in ("fields", "sub_fields")]
                rows.append(page_entities(ask["html"], *maps, ask["entity_dom"], ask["collection_dom"], ask["collection_item"]) if ask else [])
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, kind)], schema.names)

    # names with dots reach Python only inside a struct
    return packed.select(F.struct(*[F.col(f"`{c}`") for c in kept], F.col(out)).alias("row")).mapInArrow(run, schema)


def entity_writes(entities: Column, first_rank: int, limit: int | None = None) -> Column:
    """The fields as writes of an index document: the entity at ``first_rank``, an item one rank later than the one before."""
    writes = F.transform(entities, lambda e: F.struct(e["field"].alias("field"), (e["item"] + first_rank).alias("rnk"), e["value"].alias("value")))
    return writes if limit is None else F.filter(writes, lambda w: F.char_length(w["value"]) < limit)
