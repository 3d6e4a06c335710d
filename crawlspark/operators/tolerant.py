"""Tolerant HTML tier: the standard library's parser inside Arrow batches, for broken markup."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.functions import urls as U
from crawlspark.operators.links import LINK_TARGETS, follow_rules

_VOID = {"area", "base", "br", "col", "embed", "frame", "hr", "img", "input", "link", "meta", "source", "wbr"}
_BLOCKS = {"p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "div", "article", "section", "blockquote", "pre", "tr", "br"}
_BOILER = {"nav", "footer", "header", "aside", "form"}


def _squeeze(text: str) -> str:
    return re.sub(r"[ \t\n\x0b\f\r]+", " ", text).strip(" ")


class _Events(HTMLParser):
    """Page text, links and text blocks in one pass over the markup."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.links: list[dict] = []
        self.blocks: list[list] = []  # words, words inside links, text
        self.open_links: list[dict] = []
        self.boiler = 0
        self.in_title = False
        self.title = ""
        self.heading = ""
        self.in_h1 = False
        self._new_block()

    def _new_block(self) -> None:
        self.block = [0, 0, []]
        self.blocks.append(self.block)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        values = {}
        for name, value in attrs:
            values.setdefault(name, value or "")
        for link in self.open_links[-1:]:
            link["elements"] += 1
            link["only"] = tag
        if tag in LINK_TARGETS:
            if tag == "a":
                # a second anchor level ends the outer text
                for link in self.open_links:
                    link["anchors"] += 1
            link = {
                "tag": tag,
                "target": values.get(LINK_TARGETS[tag]),
                "rel": values.get("rel"),
                "method": values.get("method"),
                "text": [],
                "elements": 0,
                "only": None,
                "bare_text": False,
                "children": 0,
                "anchors": 1 if tag == "a" else 0,
            }
            self.links.append(link)
            if tag in ("a", "form"):
                self.open_links.append(link)
        if tag == "title":
            self.in_title = True
        if tag == "h1":
            self.in_h1 = True
        if tag in _BOILER:
            self.boiler += 1
        if tag in _BLOCKS:
            self._new_block()

    def handle_endtag(self, tag: str) -> None:
        if tag in ("a", "form"):
            for i in range(len(self.open_links) - 1, -1, -1):
                if self.open_links[i]["tag"] == tag:
                    del self.open_links[i]
                    break
        if tag == "title":
            self.in_title = False
        if tag == "h1":
            self.in_h1 = False
        if tag in _BOILER and self.boiler:
            self.boiler -= 1
        if tag in _BLOCKS:
            self._new_block()

    def handle_data(self, data: str) -> None:
        if self.cdata_elem in ("script", "style"):
            return
        for link in self.open_links[-1:]:
            link["children"] += 1
            if data.strip():
                link["bare_text"] = True
        text = _squeeze(data)
        if not text:
            return
        self.texts.append(text)
        for link in self.open_links:
            if link["anchors"] <= 1:
                link["text"].append(text)
        if self.in_title:
            self.title = (self.title + " " + text).strip()
            return
        if self.in_h1 and not self.heading:
            self.heading = text
        if not self.boiler:
            words = len(text.split(" "))
            self.block[0] += words
            self.block[1] += words if any(link["tag"] == "a" for link in self.open_links) else 0
            self.block[2].append(text)


def _read(markup: str | None) -> _Events:
    events = _Events()
    events.feed(markup or "")
    events.close()
    return events


def _empty_container(link: dict) -> bool:
    """No inner structure, or nothing but one nested element of the same name."""
    if link["tag"] not in ("a", "form"):
        return False
    if not link["children"] and not link["elements"]:
        return True
    return link["elements"] == 1 and link["only"] == link["tag"] and not link["bare_text"]


def raw_links_tolerant(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Like ``raw_links``, for markup that regular expressions misread."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (k, pos, x["tag"], x["target"], " ".join(x["text"]), x["rel"], x["method"], _empty_container(x))
                for k, markup in zip(batch[key], batch[html])
                for pos, x in enumerate(_read(markup).links)
            ]
            yield pd.DataFrame(rows, columns=columns)

    columns = [key, "tag_pos", "tag", "target", "anchor", "rel", "method", "empty_container"]
    key_type = pages.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, tag_pos int, tag string, target string, anchor string, rel string, method string, empty_container boolean"
    return pages.select(key, html).mapInPandas(run, schema)


def extract_outlinks_tolerant(pages: DataFrame, key: str, url: str = "url", html: str = "html", ignore_tags: tuple[str, ...] = ("form",)) -> DataFrame:
    """Followed links of broken markup with resolved targets; ``key`` is ``url`` itself or carries it."""
    # the base url rides along inside the key column, so nothing is joined back
    packed = pages.select(F.to_json(F.struct(F.col(key).alias("k"), F.col(url).alias("u"))).alias("packed"), html)
    found = follow_rules(raw_links_tolerant(packed, "packed", html), ignore_tags)
    key_type = pages.schema[key].dataType.simpleString()
    unpacked = found.withColumn("p", F.from_json("packed", f"k {key_type}, u string"))
    return (
        unpacked.withColumn("to_url", U.resolve(U.base_parts(F.col("p.u")), F.col("target")))
        .where("to_url is not null")
        .select(F.col("p.k").alias(key), "tag_pos", "tag", "target", "to_url", "anchor", "rel", "method")
    )


def page_text_tolerant(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Visible text and title of broken markup."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            read = [_read(markup) for markup in batch[html]]
            yield pd.DataFrame(
                {key: batch[key], "title": [e.title for e in read], "text": [" ".join(e.texts) for e in read]}
            )

    key_type = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(run, f"{key} {key_type}, title string, text string")


def main_content_tolerant(pages: DataFrame, key: str, html: str = "html", min_words: int = 10, max_link_share: float = 0.33) -> DataFrame:
    """Main title and text of any page: text blocks with enough words and few of them inside links."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, markup in zip(batch[key], batch[html]):
                events = _read(markup)
                kept = [
                    " ".join(text)
                    for words, linked, text in events.blocks
                    if words >= min_words and linked <= max_link_share * words
                ]
                rows.append((k, events.heading or events.title, "\n".join(kept)))
            yield pd.DataFrame(rows, columns=[key, "content_title", "content_text"])

    key_type = pages.schema[key].dataType.simpleString()
    out = pages.select(key, html).mapInPandas(run, f"{key} {key_type}, content_title string, content_text string")
    return out.withColumn("content_text_length", F.length("content_text"))
