"""Views over the given tables, once per engine; they feed the registered queries and their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark.functions import urls as U

NOW = "2024-01-05 00:00:00"
BATCH = "b1"

_HOST = r"'^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^:/?#]*)'"

BOTH = {
    "fetch_log": """
select event_id, user_id as page_id, ts,
       cast(case event_type when 'view' then 200 when 'click' then 302 when 'signup' then 301
            when 'purchase' then 404 else 500 end as int) as code
from events""",
    "seeds": """
select concat(url, ' -i pt', cast(page_id % 24 as varchar(10)), 'h -p ',
              cast(1000 + page_id % 10 as varchar(10)), ' -d ', cast(page_id % 3 as varchar(10)),
              ' -amin 5 -amax ', cast(30 + page_id % 3 as varchar(10)), ' -w alpha^2,beta^0.5,gamma') as line
from pages
union all select '' as line
union all select 'not-a-url -p 5' as line""",
    "suffixes": """
select 'com' as domain, 'IN_USE' as status, cast(1.0 as double) as boost, 'GENERIC' as type
union all select 'net', 'IN_USE', 1.0, 'GENERIC'
union all select 'org', 'SPONSORED', 0.5, 'GENERIC'
union all select 'example.org', 'IN_USE', 2.0, null""",
    "host_ip": f"""
select host, concat('10.0.0.', cast(length(host) % 5 as varchar(5))) as ip
from (select distinct regexp_extract(url, {_HOST}, 1) as host
      from pages) t
where length(host) % 9 <> 0""",
    "index_fields": """
select 'id' as name, false as multi_valued
union all select 'url', false
union all select 'title', true
union all select 'author', true
union all select 'text_content', false""",
    "doc_fields": """
select concat('d', cast(doc_id as varchar(20))) as id, 'title' as field, 0 as rnk, concat(source, ' ', lang) as value from documents
union all select concat('d', cast(doc_id as varchar(20))), 'text_content', 0, text from documents
union all select concat('d', cast(doc_id as varchar(20))), 'author', 1, source from documents
union all select concat('d', cast(doc_id as varchar(20))), 'title', 2, lang from documents
union all select concat('d', cast(doc_id as varchar(20))), 'unmapped', 1, 'x' from documents""",
    "meta_pages": """
select page_id, url, concat('<html><head><meta name="robots" content="',
         case page_id % 6 when 0 then 'none' when 1 then 'noindex' when 2 then 'nofollow'
              when 3 then 'noarchive' when 4 then 'NOINDEX, NOFOLLOW' else 'all' end,
         '"><meta name="keywords" content="k', cast(page_id % 4 as varchar(5)), '"><meta name="description" content="a > b &amp; d', cast(page_id % 3 as varchar(5)), '">',
         case when page_id % 5 = 0 then '<meta http-equiv="pragma" content="no-cache">' else '' end,
         case when page_id % 4 = 1 then '<meta http-equiv="refresh" content="5; url=http://r.example.com/">'
              when page_id % 4 = 2 then '<meta http-equiv="refresh" content="7">' else '' end,
         '<meta http-equiv="Content-Type" content="text/html; charset=',
         case page_id % 3 when 0 then 'ISO-8859-1' when 1 then 'utf-8' else 'euc-kr' end,
         '"></head>', html) as html
from pages""",
    "counters": """
select concat('g', cast(user_id % 3 as varchar(5))) as grp, event_type as name,
       cast(count(*) as bigint) as value
from events group by 1, 2""",
}

_WEBDB = """
select page_id, url, page_id % 7 = 0 as is_seed, cast(page_id % 6 as int) as distance,
       cast(1000 + page_id % 5 as int) as fetch_priority, cast(page_id % 8 as int) as fetch_count,
       cast((page_id * 13) % 10 as double) / 2 as score,
       case when page_id % 3 = 0 then 'b1' when page_id % 3 = 1 then 'b2' end as mark_generate,
       case when page_id % 11 = 0 then 'Y' end as mark_inactive,
       {time} as fetch_time
from pages"""

SPARK = {
    **BOTH,
    "webdb": _WEBDB.format(time="timestampadd(HOUR, cast(page_id as int), timestamp_ntz'2024-01-01 00:00:00')"),
    "links": r"""
select page_id, url, pos, z.href as href, z.anchor as anchor
from (select page_id, url, posexplode(zip_with(
        regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1),
        regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2),
        (x, y) -> struct(x as href, y as anchor))) as (pos, z) from pages)""",
}

DUCKDB = {
    **BOTH,
    "webdb": _WEBDB.format(time="timestamp '2024-01-01 00:00:00' + to_hours(page_id)"),
    "links": """
select page_id, url, cast(unnest(range(len(h))) as int) as pos, unnest(h) as href, unnest(a) as anchor
from (select page_id, url, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) as h,
             regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) as a from pages)""",
    "redirects": """
select page_id, src, dst, page_id % 2 = 0 as temp
from (select page_id, url as src, lead(url) over (order by page_id) as dst from pages) t
where dst is not null
union all
select -1 - page_id, regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1), url, page_id % 2 = 0 from pages
union all
select -100001 - page_id, url, regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1), page_id % 2 = 1 from pages""",
}


class Fixture:
    """The given tables and the views on them for one scale folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name == "events" and dict(df.dtypes)["ts"] == "timestamp":
            df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        return df

    def view(self, name: str) -> DataFrame:
        if name == "redirects":
            return self._redirects()
        tables = {t: self.table(t) for t in ("pages", "events", "documents") if f"from {t}" in SPARK[name]}
        text = SPARK[name].replace("varchar(", "char(").replace("{", "{{").replace("}", "}}")
        # plain strings compare and concatenate alike on both engines
        for size in (5, 10, 20):
            text = text.replace(f"char({size})", "string")
        for t in tables:
            text = text.replace(f"from {t}", "from {" + t + "}")
        return self.spark.sql(text, **tables)

    def _redirects(self) -> DataFrame:
        # page ids are dense, so the next page is an equi-join and not a window over one partition
        pages = self.table("pages").select("page_id", "url")
        following = pages.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("dst"))
        even = F.col("page_id") % 2 == 0
        root = F.regexp_extract("url", "^([A-Za-z]+://[^/?#]*)", 1)
        moved = pages.join(following, "page_id").select("page_id", F.col("url").alias("src"), "dst", even.alias("temp"))
        down = pages.select((-1 - F.col("page_id")).alias("page_id"), root.alias("src"), F.col("url").alias("dst"), even.alias("temp"))
        up = pages.select((-100001 - F.col("page_id")).alias("page_id"), F.col("url").alias("src"), root.alias("dst"), (~even).alias("temp"))
        return moved.unionByName(down).unionByName(up)


def with_views(sql: str, *names: str) -> str:
    """DuckDB SQL with the named views in front; a view's own views must be named before it."""
    if not names:
        return sql
    head = ",\n".join(f"{n} as ({DUCKDB[n].strip()})" for n in names)
    glue = ",\n" + sql.lstrip()[len("with ") :] if sql.lstrip().lower().startswith("with ") else "\n" + sql
    return f"with {head}{glue}"


def keyed(pages: DataFrame) -> DataFrame:
    """Pages with their row key."""
    return pages.withColumn("key", U.reverse_key(F.col("url")))
