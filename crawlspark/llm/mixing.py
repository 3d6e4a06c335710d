"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Every source gets a share of the total size in proportion to its weight, but no more than ``max_epochs`` times
its own size. Sources above that are clamped and their excess is shared out again by weight, until no source is
above. A source then takes each of its documents ``whole`` times, and once more those that come first in a
seeded order until the rest of its target is met.

The order is an md5 over seed, id and text. The extra documents are found by a histogram over the first digits
of the md5, then exactly within the one bucket that holds the border, so a source with a third of all rows is
never sorted in one task. What the decision leaves is a row per source: copies and a border key. Documents
meet it in one join on the source.

Defined cases: null source is a source of its own, last in order; null, empty and blank texts have size 0 and
change nothing; equal rows share their key and are taken or left together; an empty table gives an empty
result; other columns are neither read nor changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.llm.common import saved, table, word_count
from crawlspark.operators.lookup import lookup_join
from crawlspark.operators.ranking import rank_rows

WEIGHTS, MAX_EPOCHS, SEED = (1, 2, 3), 3, 17
PREFIX = 3  # hex digits of the histogram's buckets


def order_key(doc_id: Column, text: Column, seed: int) -> Column:
    parts = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.md5(F.encode(parts, "UTF-8"))


def water_fill(sources: DataFrame, max_epochs: float) -> tuple[int, int]:
    """(numerator, denominator) of the level: a source's target is weight * numerator / denominator, or its cap.

    ``sources`` has weight and source_size. Each round clamps the sources above the level; one row comes back.
    """
    weight, size = F.col("weight"), F.col("source_size")
    total, free = sources.agg(F.sum(size), F.sum(weight)).first()
    over, level = -1, (total or 0, free or 0)
    while level[1]:
        above = weight * F.lit(float(level[0])) / F.lit(float(level[1])) > size * max_epochs
        n, caps, weights = sources.where(above).agg(F.count("*"), F.sum(size), F.sum(weight)).first()
        if n == over:
            break
        over, level = n, (total - max_epochs * (caps or 0), free - (weights or 0))
    return level


def plan(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """Per source of ``sized`` (source, key, size): source_size, target, whole, border (keys up to it are taken once more)."""
    source = F.col("source")
    bucket = F.substring("key", 1, PREFIX).alias("bucket")
    histogram = saved(sized.groupBy("source", bucket).agg(F.sum("size").alias("size")), "mix-histogram")
    sizes = histogram.groupBy("source").agg(F.sum("size").alias("source_size"))
    sizes = sizes.withColumns({"is_null": source.isNull().cast("int"), "name": F.coalesce(source, F.lit(""))})
    ranked = rank_rows(sizes, [], [("n", F.col("is_null")), ("s", F.col("name"))], name="place")
    cycle = F.array(*map(F.lit, weights))
    ranked = ranked.withColumn("weight", F.get(cycle, ((F.col("place") - 1) % len(weights)).cast("int")).cast("bigint"))
    sources = saved(ranked.select("source", "source_size", "weight"), "mix-sources")

    level, share = water_fill(sources, max_epochs)
    cap = (F.col("source_size") * max_epochs).cast("double")
    fill = F.col("weight") * F.lit(float(level)) / F.lit(float(share)) if share else cap
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = sources.select("source", "source_size", F.least(cap, fill).alias("target"))
    targets = targets.withColumn("whole", whole.cast("bigint"))
    targets = targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))

    # the last bucket that begins within the rest holds the border
    before = F.sum("size").over(Window.partitionBy("source").orderBy("bucket")) - F.col("size")
    buckets = histogram.withColumn("before", before).alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
    edge = (
        buckets.where((F.col("before") <= F.col("rest")) & (F.col("whole") < max_epochs))
        .groupBy(F.col("t.source").alias("source"))
        .agg(F.max_by(F.struct("bucket", "before", "rest"), "bucket").alias("edge"))
        .select("source", "edge.*")
    )
    inside = (
        sized.alias("d")
        .join(edge.alias("e"), F.col("d.source").eqNullSafe(F.col("e.source")) & (F.substring("d.key", 1, PREFIX) == F.col("e.bucket")))
        .groupBy(F.col("e.source").alias("source"), "d.key", "bucket", "before", "rest")
        .agg(F.sum("d.size").alias("size"))
    )
    until = F.sum("size").over(Window.partitionBy("source").orderBy("key")) - F.col("size") / 2 + F.col("before")
    border = (
        inside.withColumn("until", until)
        .groupBy("source")
        .agg(F.max(F.when(F.col("until") <= F.col("rest"), F.col("key")).otherwise(F.col("bucket"))).alias("border"))
    )
    return (
        targets.alias("t")
        .join(border.alias("b"), F.col("t.source").eqNullSafe(F.col("b.source")), "left")
        .select("t.source", "source_size", "target", "whole", F.coalesce("border", F.lit("")).alias("border"))
    )


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Narrow rows: doc_id, source, size and key."""
    key = order_key(F.col("doc_id"), F.col("text"), seed)
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key"))


def takes(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """A row per document: doc_id, source, size, source_size, target, repeats."""
    rows = saved(sized(docs, seed), "mix-sized")
    sources = saved(plan(rows, weights, max_epochs), "mix-plan")
    return _repeats(rows, sources).select("doc_id", "source", "size", "source_size", "target", "repeats")


def _repeats(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with what their source decided; the look-up broadcasts the sources or salts them, so no source is one task."""
    source = F.col("source")
    named = {"_null": source.isNull(), "_name": F.coalesce(source, F.lit(""))}
    joined = lookup_join(rows.withColumns(named), sources.withColumns(named).drop("source"), list(named), "inner")
    return joined.withColumn("repeats", F.col("whole") + (F.col("key") <= F.col("border")).cast("bigint"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mixed rows themselves, with the columns of ``docs``; a row taken n times is there n times."""
    sources = saved(plan(saved(sized(docs, seed), "mix-sized"), weights, max_epochs), "mix-plan")
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        "source",
        order_key(F.col("doc_id"), F.col("text"), seed).alias("key"),
    )
    taken = _repeats(keyed, sources).where("repeats > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))).select("row.*")


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    out = takes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


OP10_SQL = f"""
with d as (
  select doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
    md5('{SEED}:' || coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')) as key
  from documents),
s as (
  select source, sum(size)::bigint as source_size,
    1 + (row_number() over (order by source nulls last) - 1) % 3 as weight
  from d group by source),
r as (
  select *, sum(source_size) over () as total, sum(weight) over () as all_weight,
    coalesce(sum(source_size) over w, 0) as caps, coalesce(sum(weight) over w, 0) as used
  from s window w as (order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)),
c as (
  select *, weight * (total - {MAX_EPOCHS} * caps)::double / (all_weight - used)::double > {MAX_EPOCHS} * source_size as clamped from r),
l as (
  select (max(total) - {MAX_EPOCHS} * coalesce(sum(source_size) filter (clamped), 0))::double as level,
    (max(all_weight) - coalesce(sum(weight) filter (clamped), 0))::double as share from c),
t as (
  select source, source_size, least({MAX_EPOCHS} * source_size, case when share > 0 then weight * level / share else 0 end)::double as target from c, l),
g as (
  select source, key, sum(size) as size from d group by source, key),
q as (
  select g.source, g.key, t.source_size, t.target,
    case when t.source_size > 0 then floor(t.target / t.source_size) else 0 end as whole,
    sum(g.size) over (partition by g.source order by g.key) - g.size / 2 as until
  from g join t on g.source is not distinct from t.source)
select d.doc_id, d.size, q.source_size, q.target,
  (d.size * (q.whole + case when q.whole < {MAX_EPOCHS} and q.until <= q.target - q.whole * q.source_size then 1 else 0 end))::bigint as taken
from d join q on d.source is not distinct from q.source and d.key = q.key
"""
