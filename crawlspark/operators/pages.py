"""Page tables in, metadata, charset, type and text tables out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions import charsets as C
from crawlspark.functions import html as H
from crawlspark.functions import mimes as M
from crawlspark.functions import urls as U


def page_text(pages: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """Add the visible text: text nodes outside script, style and comments, joined by one blank."""
    bare = pages.withColumn("_bare", H.bare_text(F.col(html)))
    return bare.withColumn(name, H.readable(F.col("_bare"))).drop("_bare")


def with_head(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``_head``, the part before the body, for the operators that only read it."""
    return pages if "_head" in pages.columns else pages.withColumn("_head", H.head_of(F.col(html)))


def page_title(pages: DataFrame, html: str = "html", name: str = "title") -> DataFrame:
    """Add the title of the head, ``''`` if there is none."""
    bare = with_head(pages, html).withColumn("_bare", H.bare_title(F.col("_head")))
    return _without(bare.withColumn(name, H.readable(F.col("_bare"))), pages, "_bare", "_head")


def page_metadata(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add meta_title, meta_keywords and meta_description; null when the head has none."""
    headed = with_head(pages, html)
    found = headed.withColumns({"_m": H.metas_of(F.col("_head")), "_bare": H.bare_title(F.col("_head"))})

    def last(name: str) -> Column:
        hits = F.filter("_m", lambda m: (m["name"] == name) & m["content"].isNotNull())
        return F.get(hits, F.size(hits) - 1)["content"]

    titled = F.col("_head").rlike(r"(?i)<title[\s>]")
    out = found.withColumns(
        {
            "meta_title": F.when(titled, H.readable(F.col("_bare"))),
            "meta_keywords": last("keywords"),
            "meta_description": last("description"),
        }
    )
    return _without(out, pages, "_m", "_bare", "_head")


def _without(out: DataFrame, before: DataFrame, *helpers: str) -> DataFrame:
    return out.drop(*[h for h in helpers if h not in before.columns])


def meta_tags(pages: DataFrame, key: list[str], html: str = "html") -> DataFrame:
    """General and http-equiv tags as rows (key, kind, name, content); the last of equal names wins."""
    found = with_head(pages, html).select(*key, F.posexplode(H.metas_of(F.col("_head"))).alias("_pos", "m"))
    kinds = F.array(
        F.struct(F.lit("name").alias("kind"), F.col("m.name").alias("name")),
        F.struct(F.lit("http-equiv").alias("kind"), F.col("m.equiv").alias("name")),
    )
    rows = found.where("m.content is not null").select(*key, "_pos", "m.content", F.explode(kinds).alias("k"))
    return rows.where("k.name is not null").groupBy(*key, "k.kind", "k.name").agg(F.max_by("content", "_pos").alias("content"))


def robots_meta(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Add no_index, no_follow, no_cache, refresh_time and refresh_href from the head's meta tags."""
    headed = with_head(pages, html)
    out = headed.withColumns({"_m": H.metas_of(F.col("_head")), "_base": U.base_parts(F.col(url))})

    def robots(*words: str) -> Column:
        def hit(m: Column) -> Column:
            text = F.lower(m["content"])
            found = F.lit(False)
            for word in words:
                found = found | text.contains(word)
            return (m["name"] == "robots") & found

        return F.coalesce(F.exists("_m", hit), F.lit(False))

    pragma = F.exists("_m", lambda m: (m["equiv"] == "pragma") & F.lower(m["content"]).contains("no-cache"))
    # a refresh whose time is no number is none; the last good one counts
    refreshes = F.filter(
        "_m",
        lambda m: (m["equiv"] == "refresh")
        & F.substring_index(m["content"], ";", 1).rlike("^[+-]?[0-9]+$")
        & F.substring_index(m["content"], ";", 1).try_cast("int").isNotNull(),
    )
    out = out.withColumn("_r", F.get(refreshes, F.size(refreshes) - 1)["content"])
    after = F.when(
        F.lower("_r").contains("url="), F.expr("substr(_r, instr(lower(_r), 'url=') + 4)")
    ).otherwise(F.expr("substr(_r, instr(_r, ';') + 1)"))
    href = F.when(F.col("_r").contains(";"), F.coalesce(U.resolve(F.col("_base"), after), F.col(url))).otherwise(F.col(url))
    flagged = out.withColumns(
        {
            "no_index": robots("none", "noindex"),
            "no_follow": robots("none", "nofollow"),
            "no_cache": robots("noarchive") | F.coalesce(pragma, F.lit(False)),
            "refresh_time": F.substring_index("_r", ";", 1).try_cast("int"),
            "refresh_href": F.when(F.col("_r").isNotNull(), href),
        }
    )
    return _without(flagged, pages, "_m", "_base", "_r", "_head")


def base_href(pages: DataFrame, url: str = "url", html: str = "html", name: str = "base_url", relative: bool = False) -> DataFrame:
    """Add the page's base url: the head's first absolute ``<base href>``, else the page's own url.

    ``relative=True`` resolves each base against the page url and takes the last one.
    """
    tags = F.regexp_extract_all("_head", F.lit(rf"(?is)<base\b({H.INNER})>"), 1)
    out = with_head(pages, html).withColumns({"_hrefs": F.transform(tags, lambda a: H.attr(a, "href")), "_base": U.base_parts(F.col(url))})
    if relative:
        good = F.filter(F.transform("_hrefs", lambda h: U.resolve(F.col("_base"), h)), lambda h: h.isNotNull())
        found = F.get(good, F.size(good) - 1)
    else:
        found = F.get(F.filter("_hrefs", lambda h: U.is_valid_url(h)), F.lit(0))
    return _without(out.withColumn(name, F.coalesce(found, F.col(url))), pages, "_hrefs", "_base", "_head")


def charset_clues(pages: DataFrame, content: Column, header: Column) -> DataFrame:
    """Add the usable clues ``header_clue`` and ``sniffed_clue``; unsupported names are null.

    ``content`` is binary. Its clue is the charset of the first http-equiv content type of the head, else the first
    ``charset`` attribute of a meta tag, else the byte order mark. An unsupported name is dropped, it does not fall through.
    """
    metas = H.metas_of(H.head_of(F.decode(content, "ISO-8859-1")))
    found = pages.withColumns({"_metas": metas, "_mark": C.mark_charset(content)})
    sniffed = F.coalesce(C.meta_charset(F.col("_metas")), F.col("_mark"))
    out = found.withColumns({"header_clue": C.canonical_charset(C.header_charset(header)), "sniffed_clue": C.canonical_charset(sniffed)})
    return out.drop("_metas", "_mark")


def charset_resolution(pages: DataFrame, content: Column, header: Column, name: str = "charset", default: str = C.DEFAULT_CHARSET) -> DataFrame:
    """Add the charset of the first usable clue, header before sniffed."""
    clued = charset_clues(pages, content, header)
    return clued.withColumn(name, F.coalesce("header_clue", "sniffed_clue", F.lit(default))).drop("header_clue", "sniffed_clue")


def charset_disagreement(pages: DataFrame, content: Column, header: Column) -> DataFrame:
    """Pages whose clues name different charsets, with both clues."""
    return charset_clues(pages, content, header).where(F.col("header_clue") != F.col("sniffed_clue"))


def mime_resolution(pages: DataFrame, declared: Column, url: Column, content: Column, name: str = "mime") -> DataFrame:
    return pages.withColumn(name, M.resolve_type(declared, url, content))


def decoded(pages: DataFrame, content: Column, charset: Column, name: str = "html") -> DataFrame:
    """Add the text of binary ``content`` in a resolved charset."""
    return pages.withColumn(name, C.decode(content, charset))


def main_content(pages: DataFrame, html: str = "html", min_words: int = 10, max_link_share: float = 0.33) -> DataFrame:
    """Add content_title, content_text and its length.

    The text is that of the articles the page marks. Of other pages it is the text blocks with at least ``min_words`` words
    of which at most ``max_link_share`` are in links, and if there are none, all visible text of the body. The title is the first
    heading of that, else of the page, else the page title. A null page has nulls.
    """
    cut = with_head(pages, html).withColumn("_article", F.nullif(H.article_html(F.col(html)), F.lit("")))
    prose = F.nullif(H.prose_html(F.col(html), min_words, max_link_share), F.lit(""))
    cut = cut.withColumn("_main", F.coalesce("_article", prose, H.body_of(F.col(html))))
    heading = rf"(?is)<h1(?=[\s/>]){H.INNER}>(.*?)(?:</h1\s*>|\z)"
    bare = cut.withColumns(
        {
            "_heading": H.drop_tags(F.regexp_extract(F.coalesce("_article", H.body_of(F.col(html))), heading, 1)),
            "_title": H.bare_title(F.col("_head")),
            "_text": H.drop_tags(F.col("_main")),
        }
    )
    out = bare.withColumns(
        {
            "content_title": F.coalesce(F.nullif(H.readable(F.col("_heading")), F.lit("")), H.readable(F.col("_title"))),
            "content_text": H.readable(F.col("_text")),
        }
    ).withColumn("content_text_length", F.length("content_text"))
    return _without(out, pages, "_article", "_main", "_heading", "_title", "_text", "_head")


def page_times(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add publish_time, modified_time (text of the head's ``article:`` properties, publish time else of the first
    ``<time datetime>``) and page_category (``article:section``, else the keywords' first)."""
    found = with_head(pages, html).withColumn("_m", H.metas_of(F.col("_head")))

    def first(name: str) -> Column:
        return F.get(F.filter("_m", lambda m: (m["property"] == name) & m["content"].isNotNull()), F.lit(0))["content"]

    keywords = F.get(F.filter("_m", lambda m: (m["name"] == "keywords") & m["content"].isNotNull()), F.lit(0))["content"]
    stamp = H.attr(F.regexp_extract(H.strip_hidden(F.col(html)), rf"(?is)<time(?=[\s])({H.INNER})>", 1), "datetime")
    out = found.withColumns(
        {
            "publish_time": F.coalesce(first("article:published_time"), stamp),
            "modified_time": first("article:modified_time"),
            "page_category": F.coalesce(first("article:section"), F.nullif(F.trim(F.substring_index(keywords, ",", 1)), F.lit(""))),
        }
    )
    return _without(out, pages, "_m", "_head")


def indexable(pages: DataFrame) -> DataFrame:
    """Pages whose robots tag allows indexing; needs the columns of :func:`robots_meta`."""
    return pages.where(~F.col("no_index"))
