"""Registered queries over the given tables, each with its SQL check where SQL can say it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark import fixtures
from crawlspark.fixtures import BATCH, NOW, Fixture, keyed, with_views
from crawlspark.functions import options as O
from crawlspark.functions import urls as U
from crawlspark.functions.html import decode_entities
from crawlspark.operators import counters as K
from crawlspark.operators import docs as D
from crawlspark.operators import domains as N
from crawlspark.operators import entities as E
from crawlspark.operators import frontier as R
from crawlspark.operators import links as L
from crawlspark.operators import pageindex as X
from crawlspark.operators import pages as P
from crawlspark.operators import seeds as Q
from crawlspark.operators import state as S
from crawlspark.operators import tolerant as T
from crawlspark.operators.lookup import lookup_join
from crawlspark.operators.redirects import follow_redirects
from crawlspark.plans import jobs as J
from crawlspark.plans.rounds import crawl_rounds
from crawlspark.session import work_dir
from crawlspark.sources import xml as XS
from crawlspark.sources.buckets import put, write_buckets
from crawlspark.sources.responses import fetch_content
from crawlspark.sources.text import split_seed_text
from crawlspark.sources.webdb import upsert

Query = Callable[[Fixture], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PARTITIONS, RUN_SEED = 8, 1
NOW_SQL = f"timestamp '{NOW}'"


def now() -> Column:
    return F.lit(NOW).cast("timestamp_ntz")


def query(name: str, sql: str | None = None, views: str = "") -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql.strip(), *views.split())
        return fn

    return register


def run(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: QUERIES[name](Fixture(spark, sf_dir))


# --- SQL pieces -------------------------------------------------------------------------------

_NULL = "cast(null as varchar)"


def _host(url: str) -> str:
    return f"regexp_extract({url}, {fixtures._HOST}, 1)"


def _origin(url: str) -> str:
    return f"regexp_extract({url}, '^([A-Za-z]+://[^/?#]*)', 1)"


def _hash(text: str) -> str:
    return (
        f"list_reduce(list_prepend(0::bigint, list_transform(string_split({text}, ''), lambda c: unicode(c)::bigint)), "
        "lambda a, b: (a * 31 + b) % 4294967296)"
    )


def _part(text: str, n: int = PARTITIONS, seed: int = RUN_SEED) -> str:
    return f"cast((xor({_hash(text)}, {seed}) & 2147483647) % {n} as int)"


def _reverse(host: str) -> str:
    return f"array_to_string(list_reverse(string_split({host}, '.')), '.')"


def _key(url: str) -> str:
    rest = f"regexp_extract({url}, '^[A-Za-z]+://[^/?#]*(.*)$', 1)"
    return f"concat({_reverse(_host(url))}, ':', regexp_extract({url}, '^([A-Za-z]+)', 1), {rest})"


def _text(html: str) -> str:
    out = f"regexp_replace({html}, '(?s)<!--.*?-->', '', 'g')"
    out = f"regexp_replace({out}, '(?is)<script[^>]*>.*?</script\\s*>', '', 'g')"
    out = f"regexp_replace({out}, '(?is)<style[^>]*>.*?</style\\s*>', '', 'g')"
    out = f"regexp_replace({out}, '(?s)<[!/?A-Za-z][^>]*>', ' ', 'g')"
    out = _decode(out)
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


def _decode(text: str) -> str:
    """References as the HTML standard reads them in text: these may lack their semicolon."""
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{char}', 'g')"
    return text


def _file(url: str) -> str:
    return f"regexp_extract({url}, '^[A-Za-z]+://[^/?#]*([^#]*)', 1)"


# registered domain of every host of a relation, by unnested candidate suffixes
_DOMAINS = f"""
hosts as (select distinct {_host("url")} as host from pages),
labelled as (select host, string_split(host, '.') as labels from hosts),
candidates as (
  select host, labels, unnest(range(2, len(labels) + 1)) as i from labelled),
found as (
  select c.host, min(c.i) as i
  from candidates c join suffixes s on s.domain = array_to_string(list_slice(c.labels, c.i, len(c.labels)), '.')
  group by c.host),
domains as (
  select l.host,
         case when f.i is null then l.labels[len(l.labels)]
              else array_to_string(list_slice(l.labels, f.i - 1, len(l.labels)), '.') end as domain,
         case when f.i is not null then array_to_string(list_slice(l.labels, f.i, len(l.labels)), '.') end as suffix
  from labelled l left join found f on f.host = l.host)"""


# --- sources and sinks ------------------------------------------------------------------------


@query(
    "seed_lines",
    "select page_id, unnest([url || ' -p ' || page_id || ' -d 1', 'http://next.example.com/' || page_id]) as line from pages",
)
def seed_lines(fx: Fixture) -> DataFrame:
    text = F.concat(
        "url", F.lit(" -p "), F.col("page_id").cast("string"), F.lit(" \\\n   -d 1\nhttp://next.example.com/"), F.col("page_id").cast("string")
    )
    return split_seed_text(fx.table("pages").select("page_id", text.alias("value")))


@query(
    "webdb_scan",
    "select page_id, url, fetch_count from webdb where not (mark_inactive is not distinct from 'Y') and is_seed",
    "webdb",
)
def webdb_scan(fx: Fixture) -> DataFrame:
    return R.active_pages(fx.view("webdb")).where("is_seed").select("page_id", "url", "fetch_count")


_LATEST = "latest as (select page_id, arg_max(code, ts) as code from fetch_log group by page_id)"
_PROTOCOL = """case when {c} = 200 then 'SUCCESS' when {c} in (302, 303, 307) then 'TEMP_MOVED' when {c} = 304 then 'NOTMODIFIED'
     when {c} in (400, 410) then 'GONE' when {c} = 401 then 'ACCESS_DENIED' when {c} = 404 then 'NOTFOUND'
     when {c} between 300 and 399 then 'MOVED' else 'EXCEPTION' end"""


@query(
    "fetch_content",
    f"""with {_LATEST}
select w.page_id, w.url, l.code, {_PROTOCOL.format(c="l.code")} as protocol_status,
       case when l.code = 200 then md5(p.html) end as content_md5
from webdb w left join latest l on l.page_id = w.page_id join pages p on p.page_id = w.page_id
where w.mark_generate = 'b1'""",
    "webdb fetch_log",
)
def content_of_batch(fx: Fixture) -> DataFrame:
    batch = R.batch_pages(fx.view("webdb"), BATCH)
    got = fetch_content(batch, fx.view("fetch_log"), fx.table("pages"))
    return got.select("page_id", "url", "code", "protocol_status", F.md5(F.encode("html", "UTF-8")).alias("content_md5"))


@query(
    "index_mapping",
    """select concat('f', p_partkey) as name, p_brand as type, p_size % 2 = 0 as indexed, false as stored,
       false as required, p_size % 3 = 0 as multi_valued from part""",
)
def index_mapping(fx: Fixture) -> DataFrame:
    part = fx.table("part")
    text = F.concat(
        F.lit('<field name="f'), F.col("p_partkey").cast("string"), F.lit('" type="'), "p_brand", F.lit('" indexed="'),
        F.when(F.col("p_size") % 2 == 0, F.lit("TRUE")).otherwise("no"), F.lit('"'),
        F.when(F.col("p_size") % 3 == 0, F.lit(' multiValued="true"')).otherwise(""), F.lit("/>"),
    )
    return XS.parse_index_fields(part.select(text.alias("value")))


@query(
    "suffix_table",
    """select concat('d', c_custkey, '.example') as domain,
       case when c_custkey % 2 = 0 then c_mktsegment else 'IN_USE' end as status,
       case when c_custkey % 3 = 0 then cast(c_nationkey as double) else 1.0 end as boost,
       'COUNTRY' as type, concat('c', c_nationkey) as country from customer""",
)
def suffix_table(fx: Fixture) -> DataFrame:
    c = fx.table("customer")
    text = F.concat(
        F.lit('<tld domain="d'), F.col("c_custkey").cast("string"), F.lit('.example">'),
        F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("<status>"), "c_mktsegment", F.lit("</status>"))).otherwise(""),
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("<boost>"), F.col("c_nationkey").cast("string"), F.lit("</boost>"))).otherwise(""),
        F.lit("<country>c"), F.col("c_nationkey").cast("string"), F.lit("</country></tld>"),
    )
    return XS.parse_suffixes(c.select(text.alias("value")), "COUNTRY")


@query(
    "webdb_upsert",
    """select page_id, url, is_seed, case when page_id % 4 = 0 then fetch_count + 1 else fetch_count end as fetch_count,
       case when page_id % 4 = 0 then 1 else 0 end as version from webdb""",
    "webdb",
)
def webdb_upsert(fx: Fixture) -> DataFrame:
    table = fx.view("webdb").select("page_id", "url", "is_seed", "fetch_count", F.lit(0).alias("version"))
    changed = table.where("page_id % 4 = 0")
    once = changed.withColumns({"fetch_count": F.col("fetch_count") + 1, "version": F.lit(1)})
    return upsert(table, changed.unionByName(once), "page_id", "version")


@query("webdb_put", ORACLES["webdb_upsert"])
def webdb_put(fx: Fixture) -> DataFrame:
    table = fx.view("webdb").select("page_id", "url", "is_seed", "fetch_count", F.lit(0).alias("version"))
    base = write_buckets(table, work_dir(fx.spark, "webdb-put"), PARTITIONS, "page_id")
    changed = base.where("page_id % 4 = 0")
    once = changed.withColumns({"fetch_count": F.col("fetch_count") + 1, "version": F.lit(1)})
    return put(base, changed.unionByName(once), PARTITIONS, "page_id", "version")


@query(
    "index_write",
    f"""with picked as (
  select f.id, f.field, f.rnk, f.value, m.multi_valued,
         row_number() over (partition by f.id, f.field order by f.rnk) as r
  from doc_fields f join index_fields m on m.name = f.field),
numbered as (
  select id, part, cast((row_number() over (partition by part order by id) - 1) // 250 as int) as batch_no
  from (select distinct id, {_part("id", 4, 0)} as part from picked) t)
select p.id, p.field, p.rnk, md5(p.value) as value_md5, n.part, n.batch_no
from picked p join numbered n on n.id = p.id where p.multi_valued or p.r = 1""",
    "index_fields doc_fields",
)
def index_write(fx: Fixture) -> DataFrame:
    rows = D.sink_rows(fx.view("doc_fields"), fx.view("index_fields"))
    batches = D.batch_numbers(rows, 4)
    return rows.join(batches, "id").select(
        "id", "field", "rnk", F.md5(F.encode("value", "UTF-8")).alias("value_md5"), "part", "batch_no"
    )


@query(
    "last_batch_id",
    "select coalesce(arg_max(mark_generate, fetch_time) filter (where mark_generate is not null), 'all') as batch_id from webdb",
    "webdb",
)
def last_batch_id(fx: Fixture) -> DataFrame:
    marked = fx.view("webdb").where("mark_generate is not null")
    return R.last_batch_id(
        marked.withColumns({"batch_id": F.col("mark_generate"), "generate_time": F.col("fetch_time")})
    )


# --- filters ----------------------------------------------------------------------------------


@query("active_pages", "select page_id, mark_inactive from webdb where mark_inactive is distinct from 'Y'", "webdb")
def active_pages(fx: Fixture) -> DataFrame:
    return R.active_pages(fx.view("webdb")).select("page_id", "mark_inactive")


@query("batch_pages", "select page_id, mark_generate from webdb where mark_generate = 'b1'", "webdb")
def batch_pages(fx: Fixture) -> DataFrame:
    return R.batch_pages(fx.view("webdb"), BATCH).select("page_id", "mark_generate")


@query("not_redundant", "select page_id, is_seed, fetch_count from webdb where is_seed or fetch_count = 0", "webdb")
def not_redundant(fx: Fixture) -> DataFrame:
    return R.not_redundant(fx.view("webdb")).select("page_id", "is_seed", "fetch_count")


@query("due_pages", f"select page_id, fetch_time from webdb where fetch_time <= {NOW_SQL}", "webdb")
def due_pages(fx: Fixture) -> DataFrame:
    return R.due_pages(fx.view("webdb"), now()).select("page_id", "fetch_time")


@query(
    "has_generate_mark",
    "select page_id, mark_generate, case when mark_generate is null then -2 else 0 end as fetch_code from webdb",
    "webdb",
)
def has_generate_mark(fx: Fixture) -> DataFrame:
    return R.with_generate_code(fx.view("webdb")).select("page_id", "mark_generate", "fetch_code")


_OUTLINK_SQL = f"""
select page_id, pos, to_url, anchor,
  case when to_url = '' then 101
       when length(to_url) < 10 or length(to_url) > 60 then 102
       when length(anchor) < 5 or length(anchor) > 50 then 103
       when pos % 3 = 0 then 104
       when {_host("to_url")} = '' then 107
       when {_host("to_url")} <> {_host("url")} then 108 else 0 end as code
from (select page_id, url, pos, {_decode("anchor")} as anchor,
             case when pos % 5 = 1 then concat('http://other.example.com', href) when pos % 7 = 2 then ''
                  else concat({_origin("url")}, href) end as to_url from links) t"""


def _fixture_links(fx: Fixture) -> DataFrame:
    links = fx.view("links").withColumn("anchor", decode_entities(F.col("anchor")))
    target = (
        F.when(F.col("pos") % 5 == 1, F.concat(F.lit("http://other.example.com"), "href"))
        .when(F.col("pos") % 7 == 2, F.lit(""))
        .otherwise(U.resolve(U.base_parts(F.col("url")), F.col("href")))
    )
    return links.withColumn("to_url", target)


@query("outlink_filter", _OUTLINK_SQL, "links")
def outlink_filter(fx: Fixture) -> DataFrame:
    links = _fixture_links(fx).withColumn("opts", O.parse_options(F.lit("-umax 60")))
    links = N.with_group(N.with_group(links, F.col("url"), name="_s"), F.col("to_url"), name="_t")
    coded = L.outlink_codes(
        links, F.col("opts"), known=F.col("pos") % 3 == 0, source_group="_s", target_group="_t", ignore_external=True
    )
    return coded.select("page_id", "pos", "to_url", "anchor", "code")


def _close(exact: str) -> str:
    return f"{exact} as exact, true as within_2_percent"


@query(
    "distinct_counters",
    f"""select 'hosts' as name, {_close("count(distinct host)")} from (
  select split_part(substr(url, strpos(url, '://') + 3), '/', 1) as host from links) t
union all
select 'urls', {_close("count(distinct u)")} from (select concat({_origin("url")}, href) as u from links) t
union all
select 'users', {_close("count(distinct user_id)")} from events
union all
select 'events', {_close("count(distinct event_id)")} from events""",
    "links",
)
def distinct_counters(fx: Fixture) -> DataFrame:
    links = fx.view("links").select("page_id", U.resolve(U.base_parts(F.col("url")), F.col("href")).alias("to_url"))
    events = fx.table("events")
    parts = [
        (links, F.col("page_id"), {"hosts": U.url_host(F.col("to_url")), "urls": F.col("to_url")}),
        (events, F.col("event_id"), {"users": F.col("user_id"), "events": F.col("event_id")}),
    ]
    out = None
    for rows, number, counted in parts:
        # three rounds that share values, each with its own sketches
        rounds = [K.distinct_sketches(rows.where(number % 3 == r), counted) for r in range(3)]
        estimates = K.distinct_estimates(rounds[0].unionByName(rounds[1]).unionByName(rounds[2])).withColumnRenamed("value", "estimate")
        both = K.distinct_counts(rows, counted).join(estimates, "name")
        both = both.select("name", F.col("value").alias("exact"), (F.abs(F.col("estimate") - F.col("value")) <= 0.02 * F.col("value")).alias("within_2_percent"))
        out = both if out is None else out.unionByName(both)
    return out


@query(
    "outlink_extra_rule",
    f"""select page_id, pos, to_url, anchor, cast(case when code <> 0 then code when contains(to_url, 'an') then 301
  when length(anchor) > 8 then 302 else 0 end as int) as code from ({_OUTLINK_SQL}) w""",
    "links",
)
def outlink_extra_rule(fx: Fixture) -> DataFrame:
    """A caller's own rule on top of the built-in ones."""

    def rule(url: Column, anchor: Column) -> Column:
        return F.when(F.contains(url, F.lit("an")), 301).when(F.length(anchor) > 8, 302).otherwise(0)

    links = _fixture_links(fx).withColumn("opts", O.parse_options(F.lit("-umax 60")))
    links = N.with_group(N.with_group(links, F.col("url"), name="_s"), F.col("to_url"), name="_t")
    coded = L.outlink_codes(
        links, F.col("opts"), known=F.col("pos") % 3 == 0, source_group="_s", target_group="_t", ignore_external=True, extra=rule
    )
    return coded.select("page_id", "pos", "to_url", "anchor", "code")


@query(
    "link_filter",
    f"""select page_id, pos, to_url,
  case when length(anchor) < 3 or length(anchor) > 12 then 100
       when length(to_url) < 10 or length(to_url) > 50 then 200
       when not starts_with(to_url, 'https://') then 210
       when not ends_with(to_url, 'n') then 211
       when not contains(to_url, 'example') then 212
       when not regexp_full_match(to_url, '.*example[.](com|org)/.*') then 213 else 0 end as code
from (select page_id, pos, {_decode("anchor")} as anchor, concat({_origin("url")}, href) as to_url from links) t""",
    "links",
)
def link_filter(fx: Fixture) -> DataFrame:
    links = fx.view("links").withColumns(
        {
            "anchor": decode_entities(F.col("anchor")),
            "to_url": U.resolve(U.base_parts(F.col("url")), F.col("href")),
            "opts": O.parse_options(
                F.lit("-amin 3 -amax 12 -umax 50 -upre https:// -upos n -ucon example -ureg .*example[.](com|org)/.*")
            ),
        }
    )
    return L.link_codes(links, F.col("opts")).select("page_id", "pos", "to_url", "code")


_MIXED_URL = """case page_id % 5 when 0 then url when 1 then replace(url, 'http', 'gopher') when 2 then concat('HTTP:', substring(url, 6))
     when 3 then concat('/rel/', page_id) else concat('mailto:x@', page_id) end"""


def _mixed(fx: Fixture) -> DataFrame:
    return fx.table("pages").select("page_id", F.expr(_MIXED_URL.replace("concat('/rel/', page_id)", "concat('/rel/', cast(page_id as string))").replace("concat('mailto:x@', page_id)", "concat('mailto:x@', cast(page_id as string))")).alias("url"))


@query(
    "valid_url",
    f"""select page_id, url, regexp_matches(url, '^(?i)(https?|ftp|file|jar|mailto):') as valid
from (select page_id, {_MIXED_URL} as url from pages) t""",
)
def valid_url(fx: Fixture) -> DataFrame:
    return _mixed(fx).withColumn("valid", U.is_valid_url(F.col("url")))


@query(
    "index_value_length",
    "select id, field, rnk, length(value) as n from doc_fields where length(value) < 5000",
    "doc_fields",
)
def index_value_length(fx: Fixture) -> DataFrame:
    kept = D.value_length(fx.view("doc_fields"), 5000)
    return kept.select("id", "field", "rnk", F.char_length("value").cast("bigint").alias("n"))


@query(
    "mapped_fields",
    "select id, field, rnk, md5(value) as value_md5 from doc_fields where field in (select name from index_fields)",
    "index_fields doc_fields",
)
def mapped_fields(fx: Fixture) -> DataFrame:
    kept = D.mapped_fields(fx.view("doc_fields"), fx.view("index_fields"))
    return kept.select("id", "field", "rnk", F.md5(F.encode("value", "UTF-8")).alias("value_md5"))


@query("noindex_gate", "select page_id, url from meta_pages where page_id % 6 in (2, 3, 5)", "meta_pages")
def noindex_gate(fx: Fixture) -> DataFrame:
    return P.indexable(P.robots_meta(fx.view("meta_pages"))).select("page_id", "url")


_RULE_HTML = """concat('<body><a href="/a', cast(page_id as varchar), '"', case page_id % 4 when 0 then ' rel="NoFollow"'
     when 1 then ' rel="nofollow external"' else '' end, '>follow me</a><form action="/f"', case when page_id % 3 = 0
     then ' method="POST"' else ' method="get"' end, '>go</form><a name="x">no target</a><img src="/i.png"></body>')"""


@query(
    "link_follow_rules",
    f"""select page_id, 'a' as tag, concat('/a', page_id) as target from pages where page_id % 4 <> 0
union all select page_id, 'form', '/f' from pages where page_id % 3 <> 0
union all select page_id, 'img', '/i.png' from pages
union all select page_id, 'a', href from links""",
    "links",
)
def link_follow_rules(fx: Fixture) -> DataFrame:
    tail = F.expr(_RULE_HTML.replace("as varchar", "as string"))
    pages = fx.table("pages").select("page_id", F.concat("html", tail).alias("html"))
    return L.follow_rules(L.raw_links(pages, ["page_id"]), ignore_tags=("script",)).select("page_id", "tag", "target")


@query(
    "empty_link_rule",
    """select page_id, concat('/', n, '/', page_id) as target, n in ('empty', 'outer', 'spaced') as empty_container
from pages, (values ('empty'), ('outer'), ('inner'), ('spaced'), ('last'), ('blank'), ('image'), ('full')) v(n)
union all select page_id, href, false from links""",
    "links",
)
def empty_link_rule(fx: Fixture) -> DataFrame:
    shapes = [
        '<a href="/empty/{}"></a>',
        '<a href="/outer/{}"><a href="/inner/{}">t</a></a>',
        '<a href="/spaced/{}"> <a href="/last/{}">t</a> </a>',
        '<a href="/blank/{}"> </a>',
        '<a href="/image/{}"><img></a>',
        '<a href="/full/{}">text</a>',
    ]
    tail = F.replace(F.lit("".join(shapes)), F.lit("{}"), F.col("page_id").cast("string"))
    links = L.raw_links(fx.table("pages").select("page_id", F.concat("html", tail).alias("html")), ["page_id"])
    return links.where("tag = 'a'").select("page_id", "target", "empty_container")


# --- joins ------------------------------------------------------------------------------------


@query(
    "new_outlinks",
    """select l.page_id, l.pos, l.href from links l
where not exists (select 1 from links o where o.page_id = l.page_id and o.href = l.href and o.pos % 3 = 0)""",
    "links",
)
def new_outlinks(fx: Fixture) -> DataFrame:
    links = fx.view("links")
    return L.new_outlinks(links, links.where("pos % 3 = 0"), ["page_id"], "href").select("page_id", "pos", "href")


@query(
    "domain_lookup",
    f"with {_DOMAINS} select p.page_id, d.suffix, s.status from pages p join domains d on d.host = {_host('p.url')} left join suffixes s on s.domain = d.suffix",
    "suffixes",
)
def domain_lookup(fx: Fixture) -> DataFrame:
    found = N.with_suffix(fx.table("pages").select("page_id", "url"), U.url_host(F.col("url")), fx.view("suffixes"))
    return found.select("page_id", F.col("suffix.domain").alias("suffix"), F.col("suffix.status").alias("status"))


@query(
    "host_ip_lookup",
    f"select p.page_id, h.ip from pages p left join host_ip h on h.host = {_host('p.url')}",
    "host_ip",
)
def host_ip_lookup(fx: Fixture) -> DataFrame:
    pages = fx.table("pages").select("page_id", "url")
    return N.with_group(pages, F.col("url"), N.IP, host_ip=fx.view("host_ip"), name="ip").select("page_id", "ip")


@query(
    "insert_absent_pages",
    f"""with fresh as (select distinct concat({_origin("url")}, href) as url from links)
select url, 'old' as kind from pages union all
select url, 'new' from fresh where url not in (select url from pages)""",
    "links",
)
def insert_absent_pages(fx: Fixture) -> DataFrame:
    table = fx.table("pages").select("url", F.lit("old").alias("kind"))
    links = fx.view("links").select(U.resolve(U.base_parts(F.col("url")), F.col("href")).alias("url"))
    return L.insert_absent(table, links.distinct().withColumn("kind", F.lit("new")), "url")


@query(
    "same_host_links",
    f"""select page_id, pos, {_host("to_url")} = {_host("url")} as internal
from (select page_id, url, pos, case when pos % 5 = 1 then concat('http://other.example.com', href)
      else concat({_origin("url")}, href) end as to_url from links where pos % 7 <> 2 or pos % 5 = 1) t""",
    "links",
)
def same_host_links(fx: Fixture) -> DataFrame:
    links = _fixture_links(fx).where("to_url <> ''")
    return L.mark_same_host(links, "url", "to_url").select("page_id", "pos", "internal")


# --- aggregations -----------------------------------------------------------------------------

_CODED = f"""flags as (select mark_inactive is distinct from 'Y' as active, is_seed, fetch_count, fetch_time from webdb),
sums as (select
  cast(count(*) filter (where active) as bigint) as rows,
  cast(count(*) filter (where active and not is_seed and fetch_count > 0) as bigint) as redundant,
  cast(count(*) filter (where active and (is_seed or fetch_count = 0) and fetch_time > {NOW_SQL}) as bigint) as later,
  cast(count(*) filter (where active and (is_seed or fetch_count = 0) and fetch_time <= {NOW_SQL}) as bigint) as passed
  from flags)"""
_COUNTER_ROWS = """select 'mRows' as name, rows as value from sums union all select 'redundant', redundant from sums
union all select 'mLater', later from sums union all select 'mPersist', passed from sums
union all select 'rRows', passed from sums union all select 'rPersist', passed from sums"""


_FETCH_ROWS = """select 'rRows' as name, count(*) as value from fetched
union all select 'rFetched', count(*) from fetched where code = 200 union all select 'rIndexed', count(*) from fetched where code = 200
union all select 'rPersist', count(*) from fetched where code = 200 union all select 'rOutlinks', count(*) from accepted"""


def _with_sources() -> str:
    return f"""with {_CODED}, {_OK}, {_ACCEPTED}
select 'generate' as job, name, value from ({_COUNTER_ROWS}) t
union all select 'fetch', name, cast(value as bigint) from ({_FETCH_ROWS}) t
union all select 'inject', 'mRows', count(*) from seeds
union all select 'inject', 'mPersist', count(*) from seeds where contains(line, ' -w ')"""


@query("job_counters")
def job_counters(fx: Fixture) -> DataFrame:
    fetched = _fetched(fx)
    links = J.accepted_outlinks(fetched).groupBy("page_id").agg(F.count(F.lit(1)).alias("links"))
    parts = {
        "inject": K.inject_counters(fx.view("seeds")),
        "generate": K.generate_counters(fx.view("webdb"), now()),
        "fetch": K.fetch_counters(fetched.join(links, "page_id", "left"), outlinks="links"),
    }
    rows = [df.select(F.lit(job).alias("job"), "name", "value") for job, df in parts.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


_DEPTH = "select case when distance between 0 and 3 then cast(distance as varchar) else 'N' end as depth, count(*) as n from webdb group by 1"


@query("depth_histogram", _DEPTH, "webdb")
def depth_histogram(fx: Fixture) -> DataFrame:
    return K.depth_histogram(fx.view("webdb"))


@query(
    "age_day_histogram",
    """select case when d between 0 and 7 then cast(d as varchar) else 'N' end as days, count(*) as n
from (select date_diff('day', cast(ts as date), date '2024-01-10') as d from fetch_log) t group by 1""",
    "fetch_log",
)
def age_day_histogram(fx: Fixture) -> DataFrame:
    return K.age_day_histogram(fx.view("fetch_log"), F.col("ts"), F.lit("2024-01-10").cast("date"))


@query(
    "status_counts",
    """select case page_id % 9 when 0 then 'UNFETCHED' when 1 then 'FETCHED' when 2 then 'REDIR_TEMP' when 3 then 'REDIR_PERM'
  when 4 then 'NOTMODIFIED' when 5 then 'RETRY' when 6 then 'GONE' end as status, count(*) as n
from pages where page_id % 9 < 7 group by 1""",
)
def status_counts(fx: Fixture) -> DataFrame:
    names = F.array(*[F.lit(s) for s in (*K.STATUSES, "STRANGE", "UNKNOWN")])
    state = fx.table("pages").select(F.get(names, (F.col("page_id") % 9).cast("int")).alias("status"))
    return K.status_counts(state)


_REPORT_LINK = f"""coded as (select page_id, pos, to_url, anchor,
  case when length(to_url) < 10 or length(to_url) > 200 then 102 when length(anchor) < 5 or length(anchor) > 50 then 103
       when {_host("to_url")} = '' then 107 else 0 end as code
  from (select page_id, pos, {_decode("anchor")} as anchor, concat({_origin("url")}, href) as to_url from links) t)"""


def _coded_links(fx: Fixture) -> DataFrame:
    links = fx.view("links").withColumns(
        {"anchor": decode_entities(F.col("anchor")), "to_url": U.resolve(U.base_parts(F.col("url")), F.col("href"))}
    )
    return L.outlink_codes(links, O.default_options())


@query(
    "filter_report",
    f"""with {_REPORT_LINK}
select page_id, cast(pos + 1 as bigint) as line_no, concat(code, ' <- ', to_url, chr(9), anchor) as line from coded
union all select page_id, 0, concat(url, ' -log 0 -i PT1H -p 0 -s 0 -d 1 -z UTC -fd body -amin 5 -amax 50 -umin 10 -umax 200 -ed body') from pages""",
    "links",
)
def filter_report(fx: Fixture) -> DataFrame:
    none = F.create_map().cast("map<string,string>")
    heads = fx.table("pages").select("page_id", O.options_line(F.col("url"), O.default_options(), none, none).alias("options_text"))
    return L.filter_report(_coded_links(fx), heads, ["page_id"])


@query(
    "filter_code_counts",
    f"with {_REPORT_LINK} select page_id, code, count(*) as n from coded group by 1, 2",
    "links",
)
def filter_code_counts(fx: Fixture) -> DataFrame:
    return L.code_counts(_coded_links(fx), ["page_id"])


@query(
    "counter_status_line",
    """select string_agg(concat(grp, '.', name, ':', value), ', ' order by grp, name) as line from counters
where value <> 0 and name in ('click', 'error')""",
    "counters",
)
def counter_status_line(fx: Fixture) -> DataFrame:
    return K.status_line(fx.view("counters"), ["click", "error"], verbose=True)


@query("grouped_counters", "select grp, name, value from counters where grp in ('g0', 'g2')", "counters")
def grouped_counters(fx: Fixture) -> DataFrame:
    return K.grouped_counters(fx.view("counters"), ["g0", "g2"])


@query(
    "counter_lookup",
    """select 'hit' as kind, coalesce(max(case when grp = 'g1' and name = 'view' then value end), -1) as value from counters
union all select 'miss', coalesce(max(case when grp = 'g9' then value end), -1) from counters""",
    "counters",
)
def counter_lookup(fx: Fixture) -> DataFrame:
    counters = fx.view("counters")
    hit = K.counter_lookup(counters, "g1", "view").select(F.lit("hit").alias("kind"), "value")
    return hit.unionByName(K.counter_lookup(counters, "g9", "view").select(F.lit("miss").alias("kind"), "value"))


@query(
    "doc_multimap",
    """select id, field, cast(row_number() over (partition by id, field order by rnk) - 1 as int) as pos, md5(value) as value_md5
from doc_fields where value is not null""",
    "doc_fields",
)
def doc_multimap(fx: Fixture) -> DataFrame:
    rows = D.doc_multimap(fx.view("doc_fields"))
    return rows.select("id", "field", "pos", F.md5(F.encode("value", "UTF-8")).alias("value_md5"))


# --- order, limit, partitioning ---------------------------------------------------------------

_PASSED = f"""passed as (select * from webdb where mark_inactive is distinct from 'Y' and (is_seed or fetch_count = 0)
  and fetch_time <= {NOW_SQL})"""


@query(
    "generate_per_partition_limit",
    f"""with {_PASSED}, parted as (select page_id, url, {_part(_host("url"))} as part from passed),
ranked as (select page_id, part, row_number() over (partition by part order by url) as rank from parted)
select page_id, part, cast(rank as bigint) as rank from ranked where rank <= 24 // {PARTITIONS}""",
    "webdb",
)
def generate_per_partition_limit(fx: Fixture) -> DataFrame:
    chosen = R.generate_per_partition(fx.view("webdb"), now(), 24, PARTITIONS, run_seed=RUN_SEED)
    return chosen.select("page_id", "part", "rank")


@query(
    "selector_order",
    "select page_id, url, cast(row_number() over (order by floor(score) desc, url) as bigint) as rank from webdb",
    "webdb",
)
def selector_order(fx: Fixture) -> DataFrame:
    return R.selector_order(fx.view("webdb")).select("page_id", "url", "rank")


@query("priority_order")
def priority_order(fx: Fixture) -> DataFrame:
    ranked = R.priority_order(fx.view("webdb"), RUN_SEED)
    firsts = ranked.groupBy("fetch_priority").agg(F.min("rank").alias("first_rank"))
    return lookup_join(ranked, firsts, ["fetch_priority"], "inner").select("page_id", "fetch_priority", "first_rank")


ORACLES["priority_order"] = with_views(
    """with sizes as (select fetch_priority, count(*) as n from webdb group by 1),
firsts as (select fetch_priority, cast(1 + coalesce(sum(n) over (order by fetch_priority desc
  rows between unbounded preceding and 1 preceding), 0) as bigint) as first_rank from sizes)
select w.page_id, w.fetch_priority, f.first_rank from webdb w join firsts f on f.fetch_priority = w.fetch_priority""",
    "webdb",
)


@query(
    "generate_topn",
    f"""with {_PASSED} select page_id, url, rank from (
  select page_id, url, cast(row_number() over (order by url) as bigint) as rank from passed) t where rank <= 20""",
    "webdb",
)
def generate_topn(fx: Fixture) -> DataFrame:
    return R.generate_topn(fx.view("webdb"), now(), 20).select("page_id", "url", "rank")


@query(
    "url_partition",
    f"""with {_DOMAINS}
select p.page_id, {_part(_host("p.url"))} as by_host, {_part("d.domain")} as by_domain,
       {_part("coalesce(h.ip, p.url)")} as by_ip
from pages p join domains d on d.host = {_host("p.url")} left join host_ip h on h.host = {_host("p.url")}""",
    "suffixes host_ip",
)
def url_partition(fx: Fixture) -> DataFrame:
    suffixes, ips = fx.view("suffixes"), fx.view("host_ip")
    df = fx.table("pages").select("page_id", "url")
    for mode in (N.HOST, N.DOMAIN, N.IP):
        df = N.with_partition(df, F.col("url"), PARTITIONS, mode, RUN_SEED, suffixes, ips, f"by_{mode}")
    return N.lay_out(df.select("page_id", "by_host", "by_domain", "by_ip"), "by_host")


# --- link lists -------------------------------------------------------------------------------

_OLD = "old as (select page_id as page, href as to_url, min(pos) as p from links where pos % 3 = 0 group by 1, 2)"
_NEW = "new as (select page_id as page, href as to_url, min(pos) as p from links where pos % 2 = 0 group by 1, 2)"


def _lists(fx: Fixture) -> tuple[DataFrame, DataFrame]:
    links = fx.view("links").select(F.col("page_id").alias("page"), F.col("href").alias("to_url"), "pos")
    return links.where("pos % 3 = 0"), links.where("pos % 2 = 0")


@query(
    "index_page_add",
    f"""with {_OLD}, {_NEW},
both_lists as (select page, to_url, 0 as g, p from new union all select page, to_url, 1, p from old),
firsts as (select page, to_url, min(g * 1000000 + p) as o from both_lists group by 1, 2)
select page, to_url, cast(row_number() over (partition by page order by o, to_url) - 1 as bigint) as pos from firsts""",
    "links",
)
def index_page_add(fx: Fixture) -> DataFrame:
    old, new = _lists(fx)
    return X.add_links(old, new)


@query(
    "index_page_remove",
    f"""with {_OLD}, {_NEW},
kept as (select page, to_url, p from old o where not exists (select 1 from new n where n.page = o.page and n.to_url = o.to_url))
select page, to_url, cast(row_number() over (partition by page order by p, to_url) - 1 as bigint) as pos from kept""",
    "links",
)
def index_page_remove(fx: Fixture) -> DataFrame:
    old, new = _lists(fx)
    return X.remove_links(old, new)


@query(
    "index_home_cap",
    """select l.page_id as page, l.href as to_url, cast(l.pos as bigint) as pos
from links l join (select page_id, count(*) as n from links group by 1) c on c.page_id = l.page_id
where c.n <= 5 or l.pos < 4""",
    "links",
)
def index_home_cap(fx: Fixture) -> DataFrame:
    links = fx.view("links").select(F.col("page_id").alias("page"), F.col("href").alias("to_url"), F.col("pos").cast("bigint"))
    return X.cap_links(links, 5, 4)


_HOME = "internal://seeds"


@query(
    "index_home",
    f"""with l as (select page_id, url as to_url from pages union all select max(page_id) + 1, '{_HOME}/2' from pages),
r as (select to_url, cast(row_number() over (order by to_url <> '{_HOME}/2', page_id) - 1 as bigint) as pos, count(*) over () as n from l)
select '{_HOME}' as page, to_url, pos from r where n <= 100 or pos < 80""",
)
def index_home(fx: Fixture) -> DataFrame:
    pages = fx.table("pages").select("page_id", F.col("url").alias("to_url"))
    known = pages.agg((F.max("page_id") + 1).alias("page_id")).select("page_id", F.lit(f"{_HOME}/2").alias("to_url"))
    listed = pages.union(known).select(F.lit(_HOME).alias("page"), "to_url", F.col("page_id").alias("pos"))
    return J.index_home(listed, 2, _HOME, 100, 80)


@query(
    "old_outlinks_add",
    "select page_id as page, href as to_url from links where pos % 3 = 0 or pos % 2 = 0 group by 1, 2",
    "links",
)
def old_outlinks_add(fx: Fixture) -> DataFrame:
    return X.add_old_outlinks(*_lists(fx))


# --- urls -------------------------------------------------------------------------------------


@query("url_host", f"select page_id, {_host('url')} as host from pages")
def url_host(fx: Fixture) -> DataFrame:
    return fx.table("pages").select("page_id", U.url_host(F.col("url")).alias("host"))


@query(
    "url_hostname_lower",
    f"""select page_id, case when regexp_matches(url, '^(?i)(https?|ftp|file|jar|mailto):') then lower({_host("url")}) else 'none' end as host
from (select page_id, {_MIXED_URL} as url from pages) t""",
)
def url_hostname_lower(fx: Fixture) -> DataFrame:
    return _mixed(fx).select("page_id", U.url_hostname(F.col("url"), F.lit("none")).alias("host"))


@query(
    "url_domain",
    f"with {_DOMAINS} select p.page_id, d.domain from pages p join domains d on d.host = {_host('p.url')}",
    "suffixes",
)
def url_domain(fx: Fixture) -> DataFrame:
    pages = fx.table("pages").select("page_id", "url")
    return N.with_domain(pages, F.col("url"), fx.view("suffixes")).select("page_id", "domain")


@query(
    "url_group_key",
    f"""with {_DOMAINS}
select p.page_id, {_host("p.url")} as by_host, d.domain as by_domain, coalesce(h.ip, 'unresolved') as by_ip
from pages p join domains d on d.host = {_host("p.url")} left join host_ip h on h.host = {_host("p.url")}""",
    "suffixes host_ip",
)
def url_group_key(fx: Fixture) -> DataFrame:
    suffixes, ips = fx.view("suffixes"), fx.view("host_ip")
    df = fx.table("pages").select("page_id", "url")
    for mode in (N.HOST, N.DOMAIN, N.IP):
        df = N.with_group(df, F.col("url"), mode, suffixes, ips, f"by_{mode}")
    return df.select("page_id", "by_host", "by_domain", U.group_or_default(F.col("by_ip"), F.lit("unresolved")).alias("by_ip"))


@query(
    "url_domain_suffix",
    f"""with {_DOMAINS}
select p.page_id, s.domain, s.status, s.boost, s.type
from pages p join domains d on d.host = {_host("p.url")} left join suffixes s on s.domain = d.suffix""",
    "suffixes",
)
def url_domain_suffix(fx: Fixture) -> DataFrame:
    pages = fx.table("pages").select("page_id", "url")
    return N.with_suffix(pages, U.url_host(F.col("url")), fx.view("suffixes")).select("page_id", "suffix.*")


@query(
    "same_domain",
    f"""with {_DOMAINS}
select r.page_id, lower(a.domain) = lower(b.domain) as same_domain
from redirects r join domains a on a.host = {_host("r.src")} join domains b on b.host = {_host("r.dst")}""",
    "suffixes redirects",
)
def same_domain(fx: Fixture) -> DataFrame:
    both = N.with_same_domain(fx.view("redirects"), F.col("src"), F.col("dst"), fx.view("suffixes"))
    return both.select("page_id", "same_domain")


@query(
    "host_parts",
    f"""select page_id, unnest(labels) as label, cast(unnest(range(len(labels))) as int) as pos
from (select page_id, string_split({_host("url")}, '.') as labels from pages) t""",
)
def host_parts(fx: Fixture) -> DataFrame:
    return fx.table("pages").select("page_id", F.posexplode(U.host_labels(F.col("url"))).alias("pos", "label"))


@query("url_page", "select page_id, regexp_replace(lower(url), '[?][^#]*', '') as page from pages")
def url_page(fx: Fixture) -> DataFrame:
    return fx.table("pages").select("page_id", U.url_page(F.col("url")).alias("page"))


_WORDS = "lower(regexp_replace(href, '[^\\p{L}]', '', 'g'))"


@query(
    "url_ascii_unicode",
    f"""select page_id, pos, concat('http://w', replace({_WORDS}, 'ß', 'ss'), '.example/p?q=1#f') as back, true as ascii_only,
  regexp_matches(replace({_WORDS}, 'ß', 'ss'), '[^\\x00-\\x7F]') as converted from links""",
    "links",
)
def url_ascii_unicode(fx: Fixture) -> DataFrame:
    word = F.replace(F.lower(F.regexp_replace("href", r"[^\p{L}]", "")), F.lit("ß"), F.lit("ss"))
    urls = fx.view("links").select("page_id", "pos", F.concat(F.lit("http://w"), word, F.lit(".example/p?q=1#f")).alias("url"))
    coded = urls.withColumn("ascii", U.to_ascii(F.col("url")))
    return coded.select(
        "page_id",
        "pos",
        U.to_unicode(F.col("ascii")).alias("back"),
        (~F.col("ascii").rlike(r"[^\x00-\x7F]")).alias("ascii_only"),
        F.col("ascii").contains("xn--").alias("converted"),
    )


@query(
    "url_resolve",
    f"""select page_id, pos, href, concat({_origin("url")}, href) as absolute,
  concat({_origin("url")}, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '?p=', pos) as by_query,
  concat({_origin("url")}, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*/)', 1), 'x', pos) as by_name,
  concat(regexp_extract(url, '^([^#]*)', 1), '#f') as by_fragment,
  concat(regexp_extract(url, '^([a-z]+):', 1), '://h.example', href) as by_host
from links""",
    "links",
)
def url_resolve(fx: Fixture) -> DataFrame:
    links = fx.view("links").withColumn("base", U.base_parts(F.col("url")))
    base, pos = F.col("base"), F.col("pos").cast("string")
    return links.select(
        "page_id",
        "pos",
        "href",
        U.resolve(base, F.col("href")).alias("absolute"),
        U.resolve(base, F.concat(F.lit("?p="), pos)).alias("by_query"),
        U.resolve(base, F.concat(F.lit(" ./y/../x"), pos)).alias("by_name"),
        U.resolve(base, F.lit("#f")).alias("by_fragment"),
        U.resolve(base, F.concat(F.lit("//h.example"), "href")).alias("by_host"),
    )


_REDIRECT_PARTS = f"""parts as (
  select r.page_id, r.src, r.dst, r.temp, a.domain as sd, b.domain as dd, {_host("r.src")} as sh, {_host("r.dst")} as dh,
         {_file("r.src")} as sf, {_file("r.dst")} as df
  from redirects r join domains a on a.host = {_host("r.src")} join domains b on b.host = {_host("r.dst")}),
sized as (
  select *, sf in ('', '/') as s_root, df in ('', '/') as d_root,
         len(string_split(rtrim(sf, '/'), '/')) as sn, len(string_split(rtrim(df, '/'), '/')) as dn from parts)"""


@query(
    "redirect_representative",
    f"""with {_DOMAINS}, {_REDIRECT_PARTS}
select page_id, case
  when sd <> dd then dst
  when not temp then case when s_root then src else dst end
  when s_root and not d_root then src
  when d_root and not s_root then dst
  when not s_root and not d_root and sh = dh then
    case when dn < sn then dst when dn > sn then src when length(df) < length(sf) then dst else src end
  when len(string_split(dh, '.')) < len(string_split(sh, '.')) then dst else src end as chosen
from sized""",
    "suffixes redirects",
)
def redirect_representative(fx: Fixture) -> DataFrame:
    return J.canonical_redirects(fx.view("redirects"), fx.view("suffixes")).select("page_id", "chosen")


@query(
    "redirect_chains",
    """with recursive hop as (
  select page_id, url, cast(page_id // 50 * 50 as bigint) as first, row_number() over (order by page_id) as i from pages),
moves as (
  -- runs of fifty pages, each to the next; the last one to nowhere, to the run's first page (a cycle) or to one hub
  select a.url as src, case when b.first = a.first then b.url when a.first % 150 = 0 then f.url when a.first % 150 = 50 then 'http://hub.example.com/' end as dst,
         a.page_id % 2 = 0 as temp
  from hop a left join hop b on b.page_id = a.page_id + 1 join hop f on f.page_id = a.first),
real as (select src, min(dst) as dst, arg_min(temp, dst) as temp from moves where dst is not null and src <> dst group by src),
walk as (
  select src, dst as target, 1 as hops, temp, false as closed from real
  union all
  select w.src, r.dst, w.hops + 1, w.temp or r.temp, r.dst = w.src from walk w join real r on r.src = w.target where not w.closed and w.hops < 60)
select src, case when bool_or(closed) then src else arg_max(target, hops) end as target, cast(case when bool_or(closed) then 0 else max(hops) end as bigint) as hops,
       not bool_or(closed) and bool_or(temp) as temporary, bool_or(closed) as cyclic
from walk group by src""",
)
def redirect_chains(fx: Fixture) -> DataFrame:
    pages = fx.table("pages").select("page_id", "url", (F.floor(F.col("page_id") / 50) * 50).alias("first"))
    after = pages.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next"), F.col("first").alias("run"))
    heads = pages.where("page_id = first").select("first", F.col("url").alias("head"))
    runs = pages.join(after, "page_id", "left").join(heads, "first")
    dst = (
        F.when(F.col("run") == F.col("first"), F.col("next"))
        .when(F.col("first") % 150 == 0, F.col("head"))
        .when(F.col("first") % 150 == 50, F.lit("http://hub.example.com/"))
    )
    return follow_redirects(runs.select(F.col("url").alias("src"), dst.alias("dst"), (F.col("page_id") % 2 == 0).alias("temp")))



@query("url_reverse_key", f"select page_id, {_key('url')} as key, url as back from pages")
def url_reverse_key(fx: Fixture) -> DataFrame:
    keys = keyed(fx.table("pages"))
    return keys.select("page_id", "key", U.unreverse_key(F.col("key")).alias("back"))


# --- seed options -----------------------------------------------------------------------------

_SPLIT = "select line, regexp_extract(line, '^([^ ]*)', 1) as url, regexp_extract(line, '^[^ ]* ?(.*)$', 1) as args from seeds"


@query("seed_split", _SPLIT, "seeds")
def seed_split(fx: Fixture) -> DataFrame:
    return Q.split_seeds(fx.view("seeds"))


def _opt(name: str, default: str, kind: str = "int") -> str:
    return f"coalesce(try_cast(regexp_extract(line, ' -{name} ([^ ]+)', 1) as {kind}), {default})"


@query(
    "seed_options",
    f"""select regexp_extract(line, '^([^ ]*)', 1) as url,
  coalesce(try_cast(regexp_extract(line, ' -i pt([0-9]+)h', 1) as bigint) * 3600, 3600) as interval_s,
  {_opt("p", "0")} as priority, {_opt("d", "1")} as depth, {_opt("amin", "5")} as amin, {_opt("amax", "50")} as amax,
  200 as umax, 'body' as follow_dom, '' as bad_options from seeds""",
    "seeds",
)
def seed_options(fx: Fixture) -> DataFrame:
    seeds = Q.parse_seeds(fx.view("seeds"))
    return seeds.select(
        "url", "opts.interval_s", "opts.priority", "opts.depth", "opts.amin", "opts.amax", "opts.umax", "opts.follow_dom", "opts.bad_options"
    )


@query(
    "weighted_keywords",
    """select regexp_extract(line, '^([^ ]*)', 1) as url, k as keyword, w as weight
from seeds, (values ('alpha', 2.0::double), ('beta', 0.5::double), ('gamma', 1.0::double)) v(k, w) where contains(line, ' -w ')""",
    "seeds",
)
def weighted_keywords(fx: Fixture) -> DataFrame:
    return Q.seed_keywords(fx.view("seeds"))


@query(
    "keywords_format",
    """select page_id, concat('a^', page_id % 10, case when page_id % 4 = 1 then '.2' when page_id % 4 = 2 then '.5'
  when page_id % 4 = 3 then '.8' else '' end, ',b^1') as line from pages""",
)
def keywords_format(fx: Fixture) -> DataFrame:
    quarter = F.col("page_id") % 10 + (F.col("page_id") % 4) * 0.25
    text = F.concat(F.lit("b,a^"), quarter.cast("decimal(10,2)").cast("string"))
    return fx.table("pages").select("page_id", O.format_keywords(O.weighted_keywords(text)).alias("line"))


@query(
    "options_line",
    """select concat(regexp_extract(line, '^([^ ]*)', 1), ' -log 0 -i ',
  case when h = 0 then 'PT0S' else concat('PT', h, 'H') end, ' -p ', p, ' -s 0 -d ', d,
  ' -z UTC -fd body -w alpha^2,beta^0.5,gamma^1 -amin 5 -amax ', x, ' -umin 10 -umax 200 -ed body') as line
from (select line, cast(regexp_extract(line, ' -i pt([0-9]+)h', 1) as int) as h, regexp_extract(line, ' -p ([0-9]+)', 1) as p,
      regexp_extract(line, ' -d ([0-9]+)', 1) as d, regexp_extract(line, ' -amax ([0-9]+)', 1) as x
      from seeds where contains(line, ' -w ')) t""",
    "seeds",
)
def options_line(fx: Fixture) -> DataFrame:
    seeds = Q.valid_seeds(fx.view("seeds"))
    return seeds.select(O.options_line(F.col("url"), F.col("opts"), F.col("fields"), F.col("sub_fields")).alias("line"))


@query(
    "field_extractors",
    """select page_id, kind, name, path from (
  select page_id, 'F' as kind, 'title' as name, concat('#t', page_id, ' b') as path from pages
  union all select page_id, 'FF', 'author', '.a' from pages
  union all select page_id, 'FF', 'when', concat('.w x', page_id % 3) from pages) t""",
)
def field_extractors(fx: Fixture) -> DataFrame:
    pid = F.col("page_id").cast("string")
    args = F.concat(
        F.lit("-e article -Ftitle=#t"), pid, F.lit("%b -FFauthor=.a -FFwhen=.w%x"), (F.col("page_id") % 3).cast("string")
    )
    base = fx.table("pages").select("page_id", args.alias("args"))
    parts = [
        base.select("page_id", F.lit(flag).alias("kind"), F.explode(O.field_extractors(F.col("args"), flag)).alias("name", "path"))
        for flag in ("F", "FF")
    ]
    return parts[0].unionByName(parts[1])


def _with_paths(fx: Fixture) -> DataFrame:
    """Pages with seed options whose CSS paths differ by page."""
    forms = F.array(
        F.lit("-e a -ed article -Fheading=h1 -Fad=.ad -c n -cd nav -ci li -FFlink=a"),
        F.lit('-Fheading=article%>%h1 -Fad=div[class="ad"] -cd body -ci nav>ul>li -FFlink=a[href^="/"]'),
        F.lit("-Fheading=.ad+article%h1:first-of-type,h2 -Fad=body%>%:nth-child(2) -cd nav -ci li:nth-child(odd) -FFlink=*"),
    )
    pages = fx.table("pages").withColumn("args", F.get(forms, (F.col("page_id") % 3).cast("int")))
    fields = {name: O.field_extractors(F.col("args"), flag) for name, flag in (("fields", "F"), ("sub_fields", "FF"))}
    return pages.withColumns({"opts": O.parse_options(F.col("args")), **fields})


_PLAIN = "replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
_ENTITY_SQL = f"""
select page_id, item, field, trim(regexp_replace({_PLAIN.format("value")}, '[ \\t\\r\\n]+', ' ', 'g')) as value from (
  select page_id, 0 as item, 'heading' as field, regexp_extract(html, '<h1>([^<]*)</h1>', 1) as value from pages
  union all
  select page_id, 0, 'ad', regexp_extract(html, '<div class="ad">([^<]*)</div>', 1) from pages where page_id % 3 <> 0
  union all
  select page_id, cast(case when page_id % 3 = 2 then (n + 1) // 2 else n end as int), 'link', link from (
    select page_id, unnest(links) as link, unnest(range(1, len(links) + 1)) as n
    from (select page_id, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) as links from pages) a) b
  where page_id % 3 <> 2 or n % 2 = 1) t"""


@query("entity_fields", _ENTITY_SQL)
def entity_fields(fx: Fixture) -> DataFrame:
    found = E.with_entities(_with_paths(fx)).select("page_id", F.explode("entities").alias("e"))
    return found.select("page_id", "e.*")


@query(
    "entity_index",
    f"""select page_id as id, field, cast(item + 2 as int) as rnk, value from ({_ENTITY_SQL}) w where item <= 1""",
)
def entity_index(fx: Fixture) -> DataFrame:
    pages = _with_paths(fx).withColumns({"fetch_code": F.lit(0), "crawl_opts": F.col("args")})
    return J.index_fields(pages, "page_id", paths=True).where("field in ('heading', 'ad', 'link')")


@query(
    "duration_parse",
    """select page_id, case page_id % 6 when 0 then page_id when 1 then page_id * 60 when 2 then page_id * 3600
  when 3 then page_id * 86400 when 4 then 86400 + page_id * 60 + 5 end as seconds from pages""",
)
def duration_parse(fx: Fixture) -> DataFrame:
    pid = F.col("page_id").cast("string")
    forms = F.array(
        F.concat(F.lit("pt"), pid, F.lit("s")),
        F.concat(pid, F.lit("m")),
        F.concat(F.lit("PT"), pid, F.lit("H")),
        F.concat(pid, F.lit("d")),
        F.concat(F.lit("P1DT"), pid, F.lit("M5S")),
        F.concat(pid, F.lit("x")),
    )
    text = F.get(forms, (F.col("page_id") % 6).cast("int"))
    return fx.table("pages").select("page_id", O.duration_seconds(text).alias("seconds"))


@query(
    "instant_parse",
    """select event_id, case when event_id % 3 = 0 then timestamp '1970-01-01 00:00:00' else date_trunc('second', ts) end as at
from events""",
)
def instant_parse(fx: Fixture) -> DataFrame:
    text = F.when(F.col("event_id") % 3 == 0, F.lit("soon")).otherwise(D.iso_instant(F.col("ts")))
    return fx.table("events").select("event_id", O.instant(text).alias("at"))


@query(
    "int_pair",
    "select page_id, cast(page_id as int) as first, case when page_id % 2 = 0 then cast(page_id + 1 as int) end as second from pages",
)
def int_pair(fx: Fixture) -> DataFrame:
    other = F.when(F.col("page_id") % 2 == 0, (F.col("page_id") + 1).cast("string")).otherwise("x")
    text = F.concat(F.col("page_id").cast("string"), F.lit(","), other)
    return fx.table("pages").select("page_id", O.int_pair(text).alias("p")).select("page_id", "p.first", "p.second")


# --- index documents --------------------------------------------------------------------------


@query(
    "doc_base_fields",
    f"""select {_key("url")} as id, unnest(['id', 'url', 'seed_url']) as field, 0 as rnk,
  unnest([{_key("url")}, url, concat('http://s.example/', page_id)]) as value from pages""",
)
def doc_base_fields(fx: Fixture) -> DataFrame:
    opts = F.concat(F.lit("http://s.example/"), F.col("page_id").cast("string"), F.lit(" -p 1"))
    return D.base_fields(keyed(fx.table("pages").select("page_id", "url")).withColumn("crawl_opts", opts))


@query(
    "doc_add_if_absent",
    "select id, field, md5(arg_min(value, rnk)) as value_md5, min(rnk) as rnk from doc_fields group by id, field",
    "doc_fields",
)
def doc_add_if_absent(fx: Fixture) -> DataFrame:
    rows = D.add_if_absent(fx.view("doc_fields"))
    return rows.select("id", "field", F.md5(F.encode("value", "UTF-8")).alias("value_md5"), "rnk")


@query(
    "doc_add",
    """select id, field, cast(row_number() over (partition by id, field order by rnk) - 1 as int) as pos, md5(value) as value_md5
from (select id, field, rnk, nullif(value, 'de') as value from doc_fields) t where value is not null and value <> ''""",
    "doc_fields",
)
def doc_add(fx: Fixture) -> DataFrame:
    rows = D.add_values(fx.view("doc_fields").withColumn("value", F.nullif("value", F.lit("de"))), skip_empty=True)
    return rows.select("id", "field", "pos", F.md5(F.encode("value", "UTF-8")).alias("value_md5"))


@query(
    "doc_lookup",
    """select id, 'first' as kind, arg_min(value, rnk) as value from doc_fields where field = 'title' group by id
union all select id, 'name', field from doc_fields where field <> 'unmapped' group by id, field""",
    "doc_fields",
)
def doc_lookup(fx: Fixture) -> DataFrame:
    fields = fx.view("doc_fields")
    first = D.field_value(fields, "title").select("id", F.lit("first").alias("kind"), "value")
    names = D.field_names(D.remove_field(fields, "unmapped"))
    return first.unionByName(names.select("id", F.lit("name").alias("kind"), F.col("field").alias("value")))


@query(
    "doc_multivalued",
    """select id, field, rnk, md5(value) as value_md5 from (
  select f.*, coalesce(m.multi_valued, false) as multi, row_number() over (partition by f.id, f.field order by f.rnk) as r
  from doc_fields f left join index_fields m on m.name = f.field) t where multi or r = 1""",
    "index_fields doc_fields",
)
def doc_multivalued(fx: Fixture) -> DataFrame:
    rows = D.single_or_multi(fx.view("doc_fields"), fx.view("index_fields"))
    return rows.select("id", "field", "rnk", F.md5(F.encode("value", "UTF-8")).alias("value_md5"))


@query("doc_dates", "select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as at from events")
def doc_dates(fx: Fixture) -> DataFrame:
    return fx.table("events").select("event_id", D.iso_instant(F.col("ts")).alias("at"))


@query(
    "doc_weight",
    "select id, field, rnk, 1.0::double as doc_weight, case when rnk = 0 then 2.0::double else 1.0::double end as field_weight from doc_fields",
    "doc_fields",
)
def doc_weight(fx: Fixture) -> DataFrame:
    weighted = D.with_weights(fx.view("doc_fields"), field_weight=F.when(F.col("rnk") == 0, 2.0))
    return weighted.select("id", "field", "rnk", "doc_weight", "field_weight")


@query(
    "doc_line",
    """select id, translate(concat_ws(', ',
  concat(chr(9), 'title:', chr(9), max(case when field = 'title' and rnk = 0 then value end)),
  concat(chr(9), 'author:', chr(9), max(case when field = 'author' then value end))), '[]', '') as line
from doc_fields where field in ('title', 'author') group by id""",
    "doc_fields",
)
def doc_line(fx: Fixture) -> DataFrame:
    return D.doc_line(fx.view("doc_fields"), ["title", "author"])


# --- html -------------------------------------------------------------------------------------


@query(
    "extract_outlinks",
    f"""select page_id, 'a' as tag, href as target, concat({_origin("url")}, href) as to_url,
  trim(regexp_replace({_decode("anchor")}, '\\s+', ' ', 'g')) as anchor from links""",
    "links",
)
def extract_outlinks(fx: Fixture) -> DataFrame:
    links = L.extract_outlinks(fx.table("pages"), ["page_id"])
    return links.select("page_id", "tag", "target", "to_url", "anchor")


@query("extract_outlinks_tolerant", ORACLES["extract_outlinks"])
def extract_outlinks_tolerant(fx: Fixture) -> DataFrame:
    links = T.extract_outlinks_tolerant(fx.table("pages"), "page_id")
    return links.select("page_id", "tag", "target", "to_url", "anchor")


@query(
    "seed_anchors",
    f"""select page_id, href, to_url, anchor from (
  select page_id, href, concat({_origin("url")}, href) as to_url, {_decode("anchor")} as anchor from links) t
where length(to_url) between 10 and 200 and length(anchor) between 5 and 50 and {_host("to_url")} <> ''""",
    "links",
)
def seed_anchors(fx: Fixture) -> DataFrame:
    pages = fx.table("pages").withColumn("is_seed", F.lit(True))
    coded = L.outlink_codes(L.seed_anchors(pages, ["page_id"]), O.default_options())
    return coded.where("code = 0").select("page_id", "href", "to_url", "anchor")


@query("page_text", f"select page_id, {_text('html')} as text from pages")
def page_text(fx: Fixture) -> DataFrame:
    return P.page_text(fx.table("pages")).select("page_id", "text")


@query("page_text_tolerant", f"select page_id, {_text('html')} as text from pages")
def page_text_tolerant(fx: Fixture) -> DataFrame:
    return T.page_text_tolerant(fx.table("pages"), "page_id").select("page_id", "text")


@query(
    "robots_meta",
    """select page_id, page_id % 6 in (0, 1, 4) as no_index, page_id % 6 in (0, 2, 4) as no_follow,
  page_id % 6 = 3 or page_id % 5 = 0 as no_cache,
  case page_id % 4 when 1 then 5 when 2 then 7 end as refresh_time,
  case page_id % 4 when 1 then 'http://r.example.com/' when 2 then url end as refresh_href from meta_pages""",
    "meta_pages",
)
def robots_meta(fx: Fixture) -> DataFrame:
    flags = P.robots_meta(fx.view("meta_pages"))
    return flags.select("page_id", "no_index", "no_follow", "no_cache", "refresh_time", "refresh_href")


@query(
    "meta_tag_map",
    """select page_id, 'name' as kind, 'robots' as name, case page_id % 6 when 0 then 'none' when 1 then 'noindex' when 2 then 'nofollow'
  when 3 then 'noarchive' when 4 then 'NOINDEX, NOFOLLOW' else 'all' end as content from pages
union all select page_id, 'name', 'keywords', concat('k', page_id % 4) from pages
union all select page_id, 'name', 'description', concat('a > b & d', page_id % 3) from pages
union all select page_id, 'http-equiv', 'pragma', 'no-cache' from pages where page_id % 5 = 0
union all select page_id, 'http-equiv', 'refresh', case page_id % 4 when 1 then '5; url=http://r.example.com/' else '7' end
  from pages where page_id % 4 in (1, 2)
union all select page_id, 'http-equiv', 'content-type', concat('text/html; charset=',
  case page_id % 3 when 0 then 'ISO-8859-1' when 1 then 'utf-8' else 'euc-kr' end) from pages""",
)
def meta_tag_map(fx: Fixture) -> DataFrame:
    return P.meta_tags(fx.view("meta_pages"), ["page_id"])


@query(
    "page_title",
    f"""select page_id, trim(regexp_replace({_decode("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")}, '\\s+', ' ', 'g')) as title from pages""",
)
def page_title(fx: Fixture) -> DataFrame:
    return P.page_title(fx.table("pages")).select("page_id", "title")


@query(
    "page_metadata",
    f"""select page_id, {_text("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} as meta_title,
  concat('k', page_id % 4) as meta_keywords, concat('a > b & d', page_id % 3) as meta_description from pages""",
)
def page_metadata(fx: Fixture) -> DataFrame:
    found = P.page_metadata(fx.view("meta_pages"))
    return found.select("page_id", "meta_title", "meta_keywords", "meta_description")


_ARTICLE = "regexp_extract(html, '(?is)<article[^>]*>(.*?)</article\\s*>', 1)"


# markup that real pages have and the given ones lack, put around them; what it means is known by construction


@query(
    "page_text_broken",
    f"""select page_id, concat({_text("html")}, ' it''s tail', page_id, ' & © A no') as text from pages""",
)
def page_text_broken(fx: Fixture) -> DataFrame:
    tail = F.concat(F.lit("<p title=it's data-x='a>b'>it's<!-- x > y --> tail"), "page_id", F.lit(" &amp &copy &#0000000065; <a title=\"<p>\">no</a></p><script>var x = '<p>';"))
    pages = fx.table("pages").select("page_id", F.concat("html", tail).alias("html"))
    return P.page_text(pages).select("page_id", "text")


@query(
    "head_rules",
    "select page_id, concat('T', page_id, ' & b © 2020 ', chr(8800)) as title, true as no_index, 2147483647 as refresh_time from pages",
)
def head_rules(fx: Fixture) -> DataFrame:
    head = F.concat(
        F.lit('<html><head><!-- <body> --><script>document.write("<body>")</script><meta data-x="1 > 0" name="robots" content="noindex"><title>T'),
        "page_id",
        F.lit(' &amp b &copy 2020 &ne;</title><meta http-equiv="refresh" content="2147483647"></head>'),
    )
    pages = fx.table("pages").select("page_id", "url", F.concat(head, "html").alias("html"))
    return P.robots_meta(P.page_title(pages)).select("page_id", "title", "no_index", "refresh_time")


@query(
    "link_markup",
    f"""select page_id, concat('http://base.example.com/d/f', page_id) as to_url, 'go one mid' as anchor from pages
union all select page_id, 'http://base.example.com/d/one?a=1&copy=2', 'one' from pages
union all select page_id, 'http://base.example.com/two', 'two' from pages
union all select page_id, concat('http://base.example.com', href), {_decode("anchor")} from links""",
    "links",
)
def link_markup(fx: Fixture) -> DataFrame:
    start = F.concat(
        F.lit('<html><head><base href="http://base.example.com/d/"></head><body><form action="f'),
        "page_id",
        F.lit('">go <a data-x="1 > 0" href="one?a=1&copy=2">one</a> mid <a href="/two">two</a> end</form>'),
    )
    pages = fx.table("pages").select("page_id", "url", F.concat(start, "html").alias("html"))
    return L.extract_outlinks(pages, ["page_id"], ignore_tags=("none",)).select("page_id", "to_url", "anchor")


_BLOCK_LIST = (
    "list_filter(list_transform(regexp_split_to_array(regexp_extract(regexp_replace(html, '<!--.*?-->', '', 'gs'), '(?is)<body>(.*)', 1),"
    " '</?(?:body|html|nav|ul|li|div|article|h1|p|footer)[^>]*>'), lambda b: trim(regexp_replace(regexp_replace(b, '<a [^>]*>[^<]*</a>|<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))),"
    " lambda b: len(string_split(b, ' ')) >= 10)"
)


@query(
    "main_content_blocks",
    f"""select page_id, md5(case when len({_BLOCK_LIST}) > 0 then {_decode(f"array_to_string({_BLOCK_LIST}, ' ')")}
  else {_text("regexp_extract(html, '(?is)<body>(.*)', 1)")} end) as text_md5 from pages""",
)
def main_content_blocks(fx: Fixture) -> DataFrame:
    html = F.regexp_replace("html", "</?article>", "")
    pages = P.main_content(fx.table("pages").select("page_id", html.alias("html")))
    return pages.select("page_id", F.md5(F.encode("content_text", "UTF-8")).alias("text_md5"))


@query(
    "nested_articles",
    f"""select page_id, concat('first inner tail ', {_text(_ARTICLE)}) as content_text from pages""",
)
def nested_articles(fx: Fixture) -> DataFrame:
    html = F.concat(F.lit("<article>first <article>inner</article> tail</article><p>between</p>"), "html")
    return P.main_content(fx.table("pages").select("page_id", html.alias("html"))).select("page_id", "content_text")


@query(
    "base_href",
    """select page_id, case page_id % 3 when 0 then 'http://b.example.com/x/' else url end as base_url,
  case page_id % 3 when 0 then 'http://b.example.com/x/' when 1 then concat(regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1), '/r/') else url end as relative_base
from pages""",
)
def base_href(fx: Fixture) -> DataFrame:
    tag = F.when(F.col("page_id") % 3 == 0, F.lit('<base href="http://b.example.com/x/">')).when(
        F.col("page_id") % 3 == 1, F.lit("<BASE HREF='/r/'>")
    )
    html = F.concat(F.lit("<html><head>"), F.coalesce(tag, F.lit("")), F.lit("</head><body>"), F.col("html"), F.lit("</body></html>"))
    pages = fx.table("pages").select("page_id", "url", html.alias("html"))
    both = P.base_href(P.base_href(pages), name="relative_base", relative=True)
    return both.select("page_id", "base_url", "relative_base")


_HEADER = "case page_id % 4 when 0 then 'text/html; charset=gbk' when 1 then 'text/html; charset=nonsense' when 2 then 'text/html' end"
_SNIFFED = "case page_id % 3 when 0 then 'windows-1252' when 1 then 'utf-8' else 'x-windows-949' end"


@query(
    "charset_resolution",
    f"select page_id, case when page_id % 4 = 0 then 'gbk' else {_SNIFFED} end as charset from pages",
)
def charset_resolution(fx: Fixture) -> DataFrame:
    pages = fx.view("meta_pages").withColumn("content", F.encode("html", "UTF-8"))
    return P.charset_resolution(pages, F.col("content"), F.expr(_HEADER)).select("page_id", "charset")


@query(
    "charset_disagreement",
    f"select page_id, 'gbk' as header_clue, {_SNIFFED} as sniffed_clue from pages where page_id % 4 = 0",
)
def charset_disagreement(fx: Fixture) -> DataFrame:
    pages = fx.view("meta_pages").withColumn("content", F.encode("html", "UTF-8"))
    return P.charset_disagreement(pages, F.col("content"), F.expr(_HEADER)).select("page_id", "header_clue", "sniffed_clue")


@query(
    "mime_resolution",
    """select page_id, case when page_id % 5 <> 1 then 'text/html' when page_id % 3 = 0 then 'application/json'
  when regexp_matches(url, '[.]html([?#]|$)') then 'text/html' else 'application/octet-stream' end as mime from pages""",
)
def mime_resolution(fx: Fixture) -> DataFrame:
    declared = F.when(F.col("page_id") % 3 == 0, F.lit("application/json; charset=utf-8")).otherwise("application/octet-stream")
    # what comes before the markup doesn't count, however long it is
    start = F.expr("case page_id % 4 when 0 then '' when 1 then repeat(' ', 5000) when 2 then concat('\ufeff', repeat('\\n', 70)) else '<!-- <xml> -->' end")
    content = F.when(F.col("page_id") % 5 != 1, F.encode(F.concat(start, F.col("html")), "UTF-8"))
    pages = fx.table("pages")
    return P.mime_resolution(pages, declared, F.col("url"), content).select("page_id", "mime")


@query(
    "main_content",
    f"""select page_id, {_text(f"regexp_extract({_ARTICLE}, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} as content_title,
  {_text(_ARTICLE)} as content_text, cast(length({_text(_ARTICLE)}) as int) as content_text_length from pages""",
)
def main_content(fx: Fixture) -> DataFrame:
    return P.main_content(fx.table("pages")).select("page_id", "content_title", "content_text", "content_text_length")


@query("main_content_tolerant")
def main_content_tolerant(fx: Fixture) -> DataFrame:
    return T.main_content_tolerant(fx.table("pages"), "page_id")


# --- state ------------------------------------------------------------------------------------


@query(
    "inject",
    f"""select {_key("url")} as key, url, true as is_seed, 0 as distance, 'UNFETCHED' as status, p as fetch_priority, 0 as fetch_count,
  h * 3600 as fetch_interval_s, {NOW_SQL} as fetch_time, 'Y' as mark_inject
from (select regexp_extract(line, '^([^ ]*)', 1) as url, cast(regexp_extract(line, ' -p ([0-9]+)', 1) as int) as p,
      cast(regexp_extract(line, ' -i pt([0-9]+)h', 1) as bigint) as h from seeds where contains(line, ' -w ')) t""",
    "seeds",
)
def inject(fx: Fixture) -> DataFrame:
    rows = J.inject(None, fx.view("seeds"), now())
    return rows.select(
        "key", "url", "is_seed", "distance", "status", "fetch_priority", "fetch_count", "fetch_interval_s", "fetch_time", "mark_inject"
    )


@query(
    "index_seeds",
    """with new_links as (select distinct regexp_extract(line, '^([^ ]*)', 1) as to_url from seeds where contains(line, ' -w ')),
old_links as (select unnest([url, concat(url, '&old')]) as to_url, page_id as p from pages),
kept as (select to_url, p from old_links where to_url not in (select to_url from new_links))
select 'internal://seeds/1' as page, to_url, cast(row_number() over (order by g, p, to_url) - 1 as bigint) as pos
from (select 0 as g, 0 as p, to_url from new_links union all select 1, p, to_url from kept) t""",
    "seeds",
)
def index_seeds(fx: Fixture) -> DataFrame:
    # known links and others
    listed = fx.table("pages").select("page_id", F.explode(F.array("url", F.concat("url", F.lit("&old")))).alias("to_url"))
    old = listed.select(F.lit("internal://seeds/1").alias("page"), "to_url", F.col("page_id").alias("pos"))
    return J.index_seeds(old, fx.view("seeds"))


@query(
    "generate",
    f"""with {_PASSED}
select page_id, url, cast(row_number() over (order by url) as bigint) as rank, 'b9' as batch_id, {NOW_SQL} as generate_time,
  'b9' as mark_generate, {_NULL} as mark_inject from passed""",
    "webdb",
)
def generate(fx: Fixture) -> DataFrame:
    batch = J.generate(fx.view("webdb"), now(), "b9")
    return batch.select("page_id", "url", "rank", "batch_id", "generate_time", "mark_generate", "mark_inject")


@query(
    "fetch_classify",
    f"""select event_id, code, {_PROTOCOL.format(c="code")} as protocol_status,
  case when code between 300 and 399 then concat('http://e.example/to/', event_id) end as redirect_to
from (select event_id, cast(code + event_id % 6 as int) as code from fetch_log) t""",
    "fetch_log",
)
def fetch_classify(fx: Fixture) -> DataFrame:
    log = fx.view("fetch_log").select(
        "event_id",
        (F.col("code") + F.col("event_id") % 6).cast("int").alias("code"),
        F.lit("http://e.example/from?x=1").alias("url"),
        F.concat(F.lit("/to/"), F.col("event_id").cast("string")).alias("location"),
    )
    return S.classify_fetches(log).select("event_id", "code", "protocol_status", "redirect_to")


@query(
    "fetch_failure_status",
    """select event_id, case event_type when 'view' then 'CONNECTION_TIMED_OUT' when 'click' then 'CONNECTION_TIMED_OUT'
  when 'signup' then 'UNKNOWN_HOST' else 'EXCEPTION' end as protocol_status from events""",
)
def fetch_failure_status(fx: Fixture) -> DataFrame:
    error = (
        F.when(F.col("event_type") == "view", F.lit("java.net.ConnectException"))
        .when(F.col("event_type") == "click", F.lit("java.net.SocketTimeoutException"))
        .when(F.col("event_type") == "signup", F.lit("UnknownHostException"))
        .otherwise("java.io.IOException")
    )
    return fx.table("events").select("event_id", S.failure_status(error).alias("protocol_status"))


_OK = f"""{_LATEST},
fetched as (select w.*, l.code from webdb w left join latest l on l.page_id = w.page_id
  where w.mark_generate = 'b1' and w.mark_inactive is distinct from 'Y')"""


def _fetched(fx: Fixture) -> DataFrame:
    table = fx.view("webdb").withColumn("crawl_opts", F.when(F.col("is_seed"), F.col("url")))
    batch = R.active_pages(R.batch_pages(table, BATCH))
    return J.fetch(batch, fx.view("fetch_log"), fx.table("pages"))


@query(
    "fetch_success",
    f"""with {_OK}
select page_id, 'FETCHED' as status, fetch_count + 1 as fetch_count, case when fetch_time < {NOW_SQL} then fetch_time end as prev_fetch_time,
  {NOW_SQL} as fetch_time, 'b1' as mark_fetch, {_NULL} as mark_generate, 1 as visits from fetched where code = 200""",
    "webdb fetch_log",
)
def fetch_success(fx: Fixture) -> DataFrame:
    done = S.fetch_success(_fetched(fx).where("fetch_code = 0"), now())
    return done.select(
        "page_id", "status", "fetch_count", "prev_fetch_time", "fetch_time", "mark_fetch", "mark_generate",
        F.size("fetch_time_history").alias("visits"),
    )


@query(
    "schedule_next",
    f"""select page_id, case when is_seed then {NOW_SQL} + to_seconds(3600 * (page_id % 24)) else {NOW_SQL} + interval 3650 day end as fetch_time,
  case when is_seed then mark_inactive else 'Y' end as mark_inactive from webdb""",
    "webdb",
)
def schedule_next(fx: Fixture) -> DataFrame:
    rows = fx.view("webdb").withColumn("fetch_interval_s", 3600 * (F.col("page_id") % 24))
    return S.schedule_next(rows, now()).select("page_id", "fetch_time", "mark_inactive")


@query(
    "fetch_backoff",
    f"""with {_LATEST}
select w.page_id, w.fetch_count,
  case when coalesce(l.code, 0) <> 200 then fetch_time + to_days(fetch_count) else fetch_time end as fetch_time,
  case when coalesce(l.code, 0) <> 200 and fetch_count > 5 then 'Y' else mark_inactive end as mark_inactive
from webdb w left join latest l on l.page_id = w.page_id""",
    "webdb fetch_log",
)
def fetch_backoff(fx: Fixture) -> DataFrame:
    got = fetch_content(fx.view("webdb"), fx.view("fetch_log"), fx.table("pages"))
    coded = got.withColumn("fetch_code", F.when(F.col("protocol_status") == "SUCCESS", 0).otherwise(-1))
    return S.fetch_backoff(coded).select("page_id", "fetch_count", "fetch_time", "mark_inactive")


_ACCEPTED = f"""accepted as (select page_id, to_url, anchor from (
  select l.page_id, concat({_origin("l.url")}, href) as to_url, {_decode("anchor")} as anchor
  from links l join fetched f on f.page_id = l.page_id where f.code = 200 and f.is_seed) t
  where length(to_url) between 10 and 200 and length(anchor) between 5 and 50)"""


ORACLES["job_counters"] = with_views(_with_sources(), "webdb", "fetch_log", "links", "seeds")


@query(
    "outlink_pages",
    f"""with {_OK}, {_ACCEPTED}
select distinct {_key("to_url")} as key, to_url as url, false as is_seed, 'UNFETCHED' as status, 0 as fetch_count,
  1200::bigint as fetch_interval_s, {NOW_SQL} as fetch_time from accepted where to_url not in (select url from pages)""",
    "webdb fetch_log links",
)
def outlink_pages(fx: Fixture) -> DataFrame:
    fresh = L.outlink_pages(J.accepted_outlinks(_fetched(fx)), now())
    table = keyed(fx.table("pages").select("page_id", "url")).select("key", F.lit(0).alias("old"))
    rows = L.insert_absent(table, fresh).where("old is null")
    return rows.select("key", "url", "is_seed", "status", "fetch_count", "fetch_interval_s", "fetch_time")


@query(
    "fetch_index",
    f"""with {_OK},
ok as (select f.page_id, {_key("f.url")} as id, f.url, p.html from fetched f join pages p on p.page_id = f.page_id where f.code = 200)
select id, 'id' as field, 0 as rnk, md5(id) as value_md5 from ok
union all select id, 'url', 0, md5(url) from ok
union all select id, 'title', 1, md5({_text(f"regexp_extract({_ARTICLE}, '(?is)<h1[^>]*>(.*?)</h1>', 1)")}) from ok
union all select id, 'text_content', 1, md5({_text(_ARTICLE)}) from ok""",
    "webdb fetch_log",
)
def fetch_index(fx: Fixture) -> DataFrame:
    table = keyed(fx.view("webdb")).withColumn("crawl_opts", F.when(F.col("is_seed"), F.col("url")))
    rows = J.fetch_index(table, BATCH, fx.view("fetch_log"), fx.table("pages"), fx.view("index_fields"))
    return rows.select("id", "field", "rnk", F.md5(F.encode("value", "UTF-8")).alias("value_md5"))


STARTS = [dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6)]
_T1, _T2 = (f"timestamp '{t}'" for t in STARTS)


@query(
    "crawl_rounds",
    f"""with latest as (
  select page_id, arg_max(code, ts) filter (ts <= {_T1}) as code1, arg_max(code, ts) filter (ts <= {_T2}) as code2 from fetch_log group by page_id),
seed_rows as (select p.page_id, p.url, coalesce(l.code1, 0) = 200 as ok1, coalesce(l.code2, 0) = 200 as ok2, p.page_id % 24 as hours, 30 + p.page_id % 3 as amax
  from pages p left join latest l on l.page_id = p.page_id),
accepted as (select to_url, bool_or(ok1) as first from (
  select concat({_origin("k.url")}, k.href) as to_url, {_decode("k.anchor")} as anchor, s.amax, s.ok1
  from links k join seed_rows s on s.page_id = k.page_id where s.ok1 or s.ok2) t
  where length(to_url) between 10 and 200 and length(anchor) between 5 and amax and to_url not in (select url from seed_rows) group by to_url)
select url, true as is_seed, case when ok1 or ok2 then 'FETCHED' else 'UNFETCHED' end as status, cast(ok1 as int) + cast(ok2 as int) as fetch_count,
  case when ok2 then {_T2} + to_hours(hours) when ok1 then {_T1} + to_hours(hours) + interval 1 day else {_T1} end as fetch_time,
  case when ok2 then 'b2' when ok1 then 'b1' end as mark_fetch, case when not ok2 then 'b2' end as mark_generate, {_NULL} as mark_inactive from seed_rows
union all
select to_url, false, 'UNFETCHED', 0, case when first then {_T1} else {_T2} end, null, case when first then 'b2' end, null from accepted""",
    "fetch_log links",
)
def rounds(fx: Fixture) -> DataFrame:
    pages = fx.table("pages")
    log = fx.view("fetch_log").join(pages.select("page_id", "url"), "page_id").drop("page_id")
    start = J.inject(None, fx.view("seeds"), now())
    final = crawl_rounds(fx.spark, start, log, pages.select("url", "html"), STARTS, None, fx.view("index_fields"))
    return final.select("url", "is_seed", "status", "fetch_count", "fetch_time", "mark_fetch", "mark_generate", "mark_inactive")


# --- jobs -------------------------------------------------------------------------------------


@query(
    "extract_links",
    f"""with {_REPORT_LINK}
select page_id, to_url, anchor, code from coded""",
    "links",
)
def extract_links(fx: Fixture) -> DataFrame:
    return J.extract_links(fx.table("pages"), ["page_id"]).select("page_id", "to_url", "anchor", "code")


@query(
    "extract_pages",
    f"""select page_id, trim(regexp_replace({_decode("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")}, '\\s+', ' ', 'g')) as title,
  md5({_text("html")}) as text_md5, false as no_index, 'utf-8' as charset, 'text/html' as mime from pages""",
)
def extract_pages(fx: Fixture) -> DataFrame:
    out = J.extract_pages(fx.table("pages"))
    return out.select("page_id", "title", F.md5(F.encode("text", "UTF-8")).alias("text_md5"), "no_index", "charset", "mime")


@query(
    "enrich_urls",
    f"""with {_DOMAINS}
select p.page_id, d.host, lower(d.host) as hostname, d.domain, d.suffix, {_key("p.url")} as key,
  regexp_replace(lower(p.url), '[?][^#]*', '') as page, {_part("d.host")} as part
from pages p join domains d on d.host = {_host("p.url")}""",
    "suffixes",
)
def enrich_urls(fx: Fixture) -> DataFrame:
    out = J.enrich_urls(fx.table("pages").select("page_id", "url"), "url", fx.view("suffixes"), PARTITIONS, RUN_SEED)
    return out.select("page_id", "host", "hostname", "domain", F.col("suffix.domain").alias("suffix"), "key", "page", "part")


@query(
    "crawl_report",
    f"""with {_CODED}
select 'generate' as section, name, value from ({_COUNTER_ROWS}) t
union all select 'depth', depth, n from ({_DEPTH}) t
union all select 'response', {_PROTOCOL.format(c="code")}, count(*) from fetch_log group by 2""",
    "webdb fetch_log",
)
def crawl_report(fx: Fixture) -> DataFrame:
    return J.crawl_report(fx.view("webdb"), fx.view("fetch_log"), now())
