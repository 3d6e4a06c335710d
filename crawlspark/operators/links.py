"""Outlinks: extraction, filter codes, known links and new pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions import html as H
from crawlspark.functions import options as O
from crawlspark.functions import urls as U
from crawlspark.functions.let import let
from crawlspark.operators.domains import HOST, with_group
from crawlspark.operators.pages import base_href

# Tag -> attribute that holds its target; form is off unless asked for.
LINK_TARGETS = {
    "a": "href",
    "area": "href",
    "form": "action",
    "frame": "src",
    "iframe": "src",
    "script": "src",
    "link": "href",
    "img": "src",
}
MAX_URL_LENGTH = 1024
NEW_PAGE_INTERVAL_S = 1200

_OPENING = rf"(?i)<(?:a|area|form|frame|iframe|script|link|img)(?=[\s/>]){H.INNER}>"
# a piece starts where an anchor or form opens or closes
_EDGE = r"(?i)(?=<(?:(?:a|form)[\s/>]|/(?:a|form)\s*>))"


def raw_links(pages: DataFrame, key: list[str], html: str = "html", base: str | None = None) -> DataFrame:
    """Every link tag with its position, text, and the attributes the follow rules need.

    An anchor's text ends at its closing tag or at the next anchor, a form's at its closing tag or at
    its second anchor. With ``base`` (a column of base parts) ``to_url`` is added. A page's links are built as one array and exploded last, so
    filters on them are evaluated on plain values.
    """
    cut = pages.select(*key, *([base] if base and base not in key else []), F.split(H.hollow(F.col(html)), _EDGE).alias("_pieces"))
    links = F.flatten(
        F.transform("_pieces", lambda p, i: _links_of(p, F.get("_pieces", i + 1), _form_text(p, F.col("_pieces"), i), F.col(base) if base else None))
    )
    return cut.select(*key, F.posexplode(links).alias("tag_pos", "_l")).select(*key, "tag_pos", "_l.*")


def _form_text(piece: Column, pieces: Column, i: Column) -> Column:
    """Markup of a form up to its end or its second anchor; null for other pieces."""
    rest = F.array_join(F.slice(pieces, i + 1, F.size(pieces)), "")
    inside = F.get(F.split(rest, r"(?i)</form\s*>", 2), F.lit(0))
    parts = F.split(inside, r"(?i)(?=<a[\s/>])", 3)
    upto = F.concat(F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.lit("")))
    return F.when(piece.rlike(r"(?i)^<form[\s/>]"), upto)


def _links_of(piece: Column, following: Column, form: Column, base: Column | None) -> Column:
    def link(t: Column, i: Column) -> Column:
        view = F.struct(
            F.lower(F.regexp_extract(t, "^<([A-Za-z]+)", 1)).alias("tag"),
            H.attr_arrays(F.regexp_replace(t, "^<[A-Za-z]+", "")).alias("a"),
            (i == 0).alias("first"),
        )
        return let(view, lambda v: _link(v, piece, following, form, base))

    return F.transform(F.regexp_extract_all(piece, F.lit(_OPENING), 0), link)


def _link(v: Column, piece: Column, following: Column, form: Column, base: Column | None) -> Column:
    def attr(name: str) -> Column:
        return H.pick_attr(v["a"]["names"], v["a"]["values"], name)

    target = F.lit(None).cast("string")
    for attribute in sorted(set(LINK_TARGETS.values())):
        owners = [t for t, a in LINK_TARGETS.items() if a == attribute]
        target = F.when(v["tag"].isin(owners), attr(attribute)).otherwise(target)
    container = v["tag"].isin("a", "form") & v["first"]

    def built(goal: Column) -> Column:
        fields = [
            v["tag"].alias("tag"),
            goal.alias("target"),
            F.when(container, H.readable(H.drop_tags(F.coalesce(form, piece)))).otherwise("").alias("anchor"),
            attr("rel").alias("rel"),
            attr("method").alias("method"),
            (container & _empty(piece, following)).alias("empty_container"),
        ]
        if base is not None:
            fields.append(U.resolve(base, goal).alias("to_url"))
        return F.struct(*fields)

    return let(H.decode_entities(target, attribute=True), built)


def _empty(piece: Column, following: Column) -> Column:
    """Whether an opening tag holds nothing, or only a nested tag of its own name."""
    name = F.lower(F.regexp_extract(piece, r"^<([A-Za-z]+)", 1))
    nested = F.lower(F.regexp_extract(following, r"^<([A-Za-z]+)", 1)) == name
    bare = piece.rlike(rf"^<{H.INNER}>\z") & following.startswith("</")
    return F.coalesce(bare | (nested & piece.rlike(rf"^<{H.INNER}>\s*\z")), F.lit(False))


def follow_rules(links: DataFrame, ignore_tags: tuple[str, ...] = ("form",)) -> DataFrame:
    """Drop nofollow and post links, links without target, ignored tags and empty containers."""
    keep = (
        F.col("target").isNotNull()
        & ~F.lower(F.coalesce("rel", F.lit(""))).eqNullSafe("nofollow")
        & ~F.lower(F.coalesce("method", F.lit(""))).eqNullSafe("post")
        & ~F.col("tag").isin(*ignore_tags)
        & ~F.col("empty_container")
    )
    return links.where(keep)


def _with_base(pages: DataFrame, url: str, html: str) -> DataFrame:
    return base_href(pages, url, html, "_base_url", relative=True).withColumn("_base", U.base_parts(F.col("_base_url"))).drop("_base_url")


def extract_outlinks(pages: DataFrame, key: list[str], url: str = "url", html: str = "html", ignore_tags: tuple[str, ...] = ("form",)) -> DataFrame:
    """Followed links with targets resolved against the page's base href; those that do not resolve are left out."""
    based = _with_base(pages, url, html)
    found = follow_rules(raw_links(based, key, html, "_base"), ignore_tags)
    return found.where("to_url is not null").drop("empty_container")


def outlink_codes(
    links: DataFrame,
    opts: Column,
    to_url: str = "to_url",
    anchor: str = "anchor",
    known: Column | None = None,
    source_group: str | None = None,
    target_group: str | None = None,
    ignore_external: bool = False,
    max_url_length: int = MAX_URL_LENGTH,
    extra: Callable[[Column, Column], Column] | None = None,
    name: str = "code",
) -> DataFrame:
    """Add the code of the first rule a link fails, 0 when it passes all.

    101 empty url, 102 url length, 103 anchor length, 104 known already, 107 no host,
    108 external while external links are ignored. ``opts`` carries each page's bounds.
    ``extra`` is a caller's own rule: (url, anchor) -> code column, asked after the others.
    """
    url, text = F.col(to_url), F.coalesce(F.col(anchor), F.lit(""))
    group = F.col(target_group) if target_group else U.url_host(url)
    code = F.when(F.coalesce(url, F.lit("")) == "", 101)
    code = code.when(
        ~F.length(url).between(opts["umin"], F.least(opts["umax"], F.lit(max_url_length))), 102
    )
    code = code.when(~F.length(text).between(opts["amin"], opts["amax"]), 103)
    if known is not None:
        code = code.when(known, 104)
    code = code.when(F.coalesce(group, F.lit("")) == "", 107)
    if ignore_external:
        code = code.when(~F.col(source_group).eqNullSafe(group), 108)
    return links.withColumn(name, code.otherwise(extra(url, text) if extra else F.lit(0)))


def link_codes(links: DataFrame, opts: Column, to_url: str = "to_url", anchor: str | None = "anchor", name: str = "code") -> DataFrame:
    """Add the link filter's code: 100 anchor length, 200 url length, 210 prefix, 211 postfix,
    212 contained text, 213 pattern over the whole url, 0 pass. Empty text disables 210-213."""
    url = F.col(to_url)
    start = F.lit(False) if anchor is None else ~F.length(F.col(anchor)).between(opts["amin"], opts["amax"])
    return links.withColumn(
        name,
        F.when(start, 100)
        .when(~F.length(url).between(opts["umin"], opts["umax"]), 200)
        .when((opts["upre"] != "") & ~F.startswith(url, opts["upre"]), 210)
        .when((opts["upos"] != "") & ~F.endswith(url, opts["upos"]), 211)
        .when((opts["ucon"] != "") & ~F.contains(url, opts["ucon"]), 212)
        .when((opts["ureg"] != "") & ~F.rlike(url, F.concat(F.lit("^(?:"), opts["ureg"], F.lit(")$"))), 213)
        .otherwise(0),
    )


def mark_known(links: DataFrame, old: DataFrame, key: list[str], to_url: str = "to_url", name: str = "known") -> DataFrame:
    """Flag links whose target is among the page's old outlinks.

    Old outlinks are a table of (key, to_url), joined on both, so one page with very many links
    is many keys.
    """
    seen = old.select(*key, to_url).distinct().withColumn(name, F.lit(True))
    return links.join(seen, [*key, to_url], "left").withColumn(name, F.coalesce(name, F.lit(False)))


def new_outlinks(links: DataFrame, old: DataFrame, key: list[str], to_url: str = "to_url") -> DataFrame:
    """Links whose target is not among the page's old outlinks."""
    return links.join(old.select(*key, to_url), [*key, to_url], "left_anti")


def mark_same_host(links: DataFrame, source: str, target: str, mode: str = HOST, suffixes: DataFrame | None = None, host_ip: DataFrame | None = None, name: str = "internal") -> DataFrame:
    """Flag links that stay within the source's host, domain or IP."""
    both = with_group(links, F.col(source), mode, suffixes, host_ip, "_sg")
    both = with_group(both, F.col(target), mode, suffixes, host_ip, "_tg")
    return both.withColumn(name, F.coalesce((F.col("_sg") == F.col("_tg")) & (F.col("_tg") != ""), F.lit(False))).drop("_sg", "_tg")


def seed_anchors(pages: DataFrame, key: list[str], url: str = "url", html: str = "html", resolve: bool = True) -> DataFrame:
    """Anchors of seed pages as (href, to_url, anchor); ``resolve=False`` keeps the raw href as target."""
    seeds = _with_base(pages.where("is_seed"), url, html)
    found = raw_links(seeds, key, html, "_base").where((F.col("tag") == "a") & F.col("target").isNotNull())
    to_url = F.col("to_url") if resolve else F.col("target")
    return found.select(*key, "tag_pos", F.col("target").alias("href"), to_url.alias("to_url"), "anchor")


def outlink_pages(links: DataFrame, now: Column, to_url: str = "to_url") -> DataFrame:
    """Accepted outlinks as new rows of the web table, one per url."""
    return links.select(F.col(to_url).alias("url")).distinct().select(
        U.reverse_key(F.col("url")).alias("key"),
        "url",
        F.lit(False).alias("is_seed"),
        F.lit(0.0).cast("float").alias("score"),
        F.lit("UNFETCHED").alias("status"),
        F.lit(0).alias("fetch_priority"),
        F.lit(0).alias("fetch_count"),
        F.lit(0).alias("retries_since_fetch"),
        F.lit(NEW_PAGE_INTERVAL_S).cast("bigint").alias("fetch_interval_s"),
        now.alias("create_time"),
        now.alias("fetch_time"),
    )


def insert_absent(table: DataFrame, rows: DataFrame, key: str = "key", overwrite: bool = False) -> DataFrame:
    """Table plus the rows whose key it lacks; ``overwrite`` lets the new rows replace old ones."""
    if overwrite:
        kept = table.join(rows.select(key).distinct(), key, "left_anti")
        return kept.unionByName(rows, allowMissingColumns=True)
    return table.unionByName(rows.join(table.select(key), key, "left_anti"), allowMissingColumns=True)


def filter_report(links: DataFrame, options_text: DataFrame, key: list[str]) -> DataFrame:
    """Report lines per source page: line 0 is the options text, then ``code <- url TAB anchor``.

    Lines stay rows, so a page with very many links is never one value.
    """
    lines = links.select(
        *key,
        (F.col("pos") + 1).cast("bigint").alias("line_no"),
        F.concat(F.col("code").cast("string"), F.lit(" <- "), F.col("to_url"), F.lit("\t"), F.col("anchor")).alias("line"),
    )
    heads = options_text.select(*key, F.lit(0).cast("bigint").alias("line_no"), F.col("options_text").alias("line"))
    return heads.unionByName(lines)


def code_counts(links: DataFrame, key: list[str]) -> DataFrame:
    """Links per page and code."""
    return links.groupBy(*key, "code").agg(F.count(F.lit(1)).alias("n"))


def page_options(pages: DataFrame, crawl_opts: str = "crawl_opts") -> DataFrame:
    """Add ``opts`` parsed from each page's options text; pages without text have the defaults."""
    return pages.withColumn("opts", O.parse_options(O.seed_args(F.col(crawl_opts))))
