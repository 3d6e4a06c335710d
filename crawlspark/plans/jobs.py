"""The jobs a crawl is made of."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions import urls as U
from crawlspark.functions.options import default_options
from crawlspark.operators import counters as K
from crawlspark.operators import docs as D
from crawlspark.operators import domains as N
from crawlspark.operators import entities as E
from crawlspark.operators import frontier as R
from crawlspark.operators import links as L
from crawlspark.operators import pages as P
from crawlspark.operators import state as S
from crawlspark.operators.pageindex import HOME_KEEP, HOME_LIMIT, add_links, cap_links
from crawlspark.operators.seeds import inject as inject_rows
from crawlspark.operators.seeds import valid_seeds
from crawlspark.sources.responses import fetch_content
from crawlspark.sources.webdb import upsert

# Fixed value: url of the page that lists the index pages.
SEED_HOME = "internal://seeds"


def inject(table: DataFrame | None, lines: DataFrame, now: Column) -> DataFrame:
    """Web table with the seeds of the lines put in."""
    rows = inject_rows(lines, now)
    return rows if table is None else upsert(table, rows)


def index_seeds(old: DataFrame, lines: DataFrame, page_no: int = 1, home: str = SEED_HOME) -> DataFrame:
    """Links (page, pos, to_url) of an index page with the seeds of the lines in front, by url."""
    seeds = valid_seeds(lines).select(
        F.lit(f"{home}/{page_no}").alias("page"), F.col("url").alias("to_url"), F.lit(0).cast("bigint").alias("pos")
    )
    return add_links(old, seeds)


def index_home(listed: DataFrame, page_no: int, home: str = SEED_HOME, limit: int = HOME_LIMIT, keep: int = HOME_KEEP) -> DataFrame:
    """Links (page, pos, to_url) of the home page of index pages with an index page put first, each link once.

    A list of more than ``limit`` links keeps its first ``keep``.
    """
    first = listed.sparkSession.range(1).select(F.lit(home).alias("page"), F.lit(f"{home}/{page_no}").alias("to_url"), F.lit(0).alias("pos"))
    return cap_links(add_links(listed, first), limit, keep)


def generate(table: DataFrame, now: Column, batch_id: str, top_n: int | None = None) -> DataFrame:
    """The next batch: the first ``top_n`` due pages, or all, marked, with their rank."""
    return R.mark_generated(R.generate_topn(table, now, top_n), now, batch_id)


def fetch(
    batch: DataFrame, log: DataFrame, archive: DataFrame, key: str = "page_id", html: str = "html", as_of: Column | None = None
) -> DataFrame:
    """Batch pages with response (the latest ``as_of`` a time), content and ``fetch_code``: 0, -1 not fetched, -2 no generate mark.

    Pages without the mark are kept for backoff, but nothing is read for them.
    """
    coded = R.with_generate_code(batch)
    marked = fetch_content(coded.where("fetch_code = 0"), log, archive, key, html, as_of)
    failed = F.when(F.col("protocol_status") != "SUCCESS", -1).otherwise(0)
    return marked.withColumn("fetch_code", failed).unionByName(coded.where("fetch_code < 0"), allowMissingColumns=True)


def fetched_state(fetched: DataFrame, now: Column, start: Column | None = None, count_failures: bool = False) -> DataFrame:
    """New state rows of a fetched batch; the response columns are gone."""
    rows = fetched.drop("html", "code")
    ok = S.schedule_next(S.fetch_success(rows.where("fetch_code = 0"), now), start if start is not None else now)
    bad = S.fetch_backoff(rows.where("fetch_code < 0"), count_failures=count_failures)
    return ok.unionByName(bad, allowMissingColumns=True).drop("fetch_code")


def accepted_outlinks(fetched: DataFrame, key: str = "page_id", old: DataFrame | None = None, resolve: bool = True) -> DataFrame:
    """Outlinks of fetched seeds that pass their page's link options and are not known yet."""
    seeds = L.page_options(fetched.where("fetch_code = 0"))
    links = L.seed_anchors(seeds, [key, "opts"], resolve=resolve)
    known = None
    if old is not None:
        links = L.mark_known(links, old, [key])
        known = F.col("known")
    return L.outlink_codes(links, F.col("opts"), known=known).where("code = 0").select(key, "tag_pos", "to_url", "anchor")


def index_fields(
    fetched: DataFrame,
    key: str = "key",
    html: str = "html",
    entities: list[dict[str, Column]] | None = None,
    max_length: int | None = None,
    paths: bool = False,
) -> DataFrame:
    """Index document fields of fetched pages: base fields, extracted content, then ``entities``.

    With ``paths`` the entity and collection fields of each page's own options (opts, fields, sub_fields) come last.

    One pass over the content: pages that robots keep out of the index only write base fields. With ``max_length``
    values of that many characters or more are left out.
    """
    ok = P.robots_meta(P.with_head(fetched.where("fetch_code = 0"), html), html=html)
    shown = ok.withColumns({html: F.when(~F.col("no_index"), F.col(html)), "_head": F.when(~F.col("no_index"), F.col("_head"))})
    if paths:
        shown = E.with_entities(shown, html, out="_entities")
    content = P.charset_resolution(P.page_times(P.main_content(shown, html), html), F.encode(html, "UTF-8"), F.lit(None).cast("string"))
    extracted = {
        "title": F.col("content_title"),
        "text_content": F.col("content_text"),
        "text_content_length": F.col("content_text_length"),
        "encoding": F.when(~F.col("no_index"), F.col("charset")),
        "page_category": F.col("page_category"),
        "publish_time": F.col("publish_time"),
        "modified_time": F.col("modified_time"),
    }
    written = [D.base_entity(key), extracted, *(entities or [])]
    more = E.entity_writes(F.col("_entities"), len(written), max_length) if paths else None
    return D.page_fields(content, key, written, max_length, more)


def fetch_index(
    table: DataFrame, batch_id: str, log: DataFrame, archive: DataFrame, mapping: DataFrame, key: str = "page_id"
) -> DataFrame:
    """Index rows (id, field, rnk, value) of a batch: fetched, extracted, merged, mapped.

    Merged fields have one value each, so mapping is all the sink asks for.
    """
    batch = R.active_pages(R.batch_pages(table, batch_id))
    return D.mapped_fields(index_fields(fetch(batch, log, archive, key)), mapping)


def extract_links(
    pages: DataFrame, key: list[str], ignore_external: bool = False, mode: str = N.HOST, suffixes: DataFrame | None = None
) -> DataFrame:
    """Followed links of pages with their filter code under default options."""
    links = L.extract_outlinks(pages, [*key, "url"])
    if not ignore_external:
        return L.outlink_codes(links, default_options())
    links = N.with_group(links, F.col("url"), mode, suffixes, None, "_sg")
    links = N.with_group(links, F.col("to_url"), mode, suffixes, None, "_tg")
    coded = L.outlink_codes(links, default_options(), source_group="_sg", target_group="_tg", ignore_external=True)
    return coded.drop("_sg", "_tg")


def extract_pages(
    pages: DataFrame,
    html: str = "html",
    header: Column | None = None,
    parser: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Title, text, meta data, robots flags, charset and content type of pages; the html is dropped.

    ``parser`` is a caller's own step that adds ``title`` and ``text`` in place of the built-in one.
    """
    content_type = header if header is not None else F.lit(None).cast("string")
    start = F.encode(html, "UTF-8")
    parsed = parser(pages) if parser else P.page_title(P.with_head(P.page_text(pages, html), html), html)
    out = P.page_metadata(P.robots_meta(P.with_head(parsed, html), html=html), html)
    out = P.charset_resolution(out, start, content_type)
    return P.mime_resolution(out, content_type, F.col("url"), start).drop(html, "_head")


def enrich_urls(df: DataFrame, url: str, suffixes: DataFrame, partitions: int, run_seed: int = 0) -> DataFrame:
    """Add host, lower-cased host name, page, row key, domain, suffix record and partition."""
    col = F.col(url)
    out = df.withColumns(
        {"host": U.url_host(col), "hostname": U.url_hostname(col), "page": U.url_page(col), "key": U.reverse_key(col)}
    )
    out = N.with_suffix(N.with_domain(out, col, suffixes), F.col("host"), suffixes)
    return out.withColumn(
        "part",
        F.when(U.is_valid_url(col), U.partition_of(F.col("host"), partitions, run_seed)).otherwise(
            F.pmod(F.xxhash64(col), F.lit(partitions)).cast("int")
        ),
    )


def canonical_redirects(redirects: DataFrame, suffixes: DataFrame) -> DataFrame:
    """Add ``chosen``, the url that stands for each (src, dst, temp)."""
    return N.choose_representative(redirects, F.col("src"), F.col("dst"), F.col("temp"), suffixes)


def crawl_report(table: DataFrame, log: DataFrame, now: Column) -> DataFrame:
    """Generate counters, depth histogram and response status counts as (section, name, value)."""
    parts = [
        ("generate", K.generate_counters(table, now)),
        ("depth", K.depth_histogram(table).select(F.col("depth").alias("name"), F.col("n").alias("value"))),
        (
            "response",
            S.classify_fetches(log)
            .groupBy(F.col("protocol_status").alias("name"))
            .agg(F.count(F.lit(1)).alias("value")),
        ),
    ]
    out = None
    for section, rows in parts:
        part = rows.select(F.lit(section).alias("section"), "name", "value")
        out = part if out is None else out.unionByName(part)
    return out
