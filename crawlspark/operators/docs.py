"""Index documents as a long table: id, field, rank (writer precedence), value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions import options as O
from crawlspark.functions.let import let
from crawlspark.functions.urls import partition_of
from crawlspark.operators.lookup import lookup_join
from crawlspark.operators.ranking import ROWS_PER_BUCKET, rank_rows

MAX_VALUE_LENGTH = 100_000
BATCH_DOCS = 250


def base_fields(pages: DataFrame, key: str = "key", url: str = "url", crawl_opts: str = "crawl_opts") -> DataFrame:
    """id, url and seed_url of each page at rank 0."""
    return page_fields(pages, key, [base_entity(key, url, crawl_opts)])


def base_entity(key: str = "key", url: str = "url", crawl_opts: str = "crawl_opts") -> dict[str, Column]:
    seed_url = F.when(F.col(crawl_opts).isNotNull(), O.seed_url(F.col(crawl_opts)))
    return {"id": F.col(key), "url": F.col(url), "seed_url": seed_url}


def page_fields(
    pages: DataFrame, key: str, entities: list[dict[str, Column]], limit: int | None = None, more: Column | None = None
) -> DataFrame:
    """Fields of a page's entities, rank = place of the entity; the first writer of a name wins.

    A page's entities are columns of one row, so they merge without a shuffle. Missing values and
    values of entities after the first that reach ``limit`` characters write nothing. ``more`` are further
    writes (field, rnk, value) of the page in an array, after those of the entities.
    """
    writes = []
    for rank, entity in enumerate(entities):
        for name, column in entity.items():
            value = column.cast("string")
            if limit is not None and rank:
                value = F.when(F.char_length(value) < limit, value)
            writes.append(F.struct(F.lit(name).alias("field"), F.lit(rank).alias("rnk"), value.alias("value")))
    kept = F.filter(F.array(*writes), lambda w: w["value"].isNotNull())
    names = [name for entity in entities for name in entity]
    if more is not None:
        kept = F.concat(kept, F.coalesce(more, F.array().cast("array<struct<field:string,rnk:int,value:string>>")))
    if more is not None or len(set(names)) < len(names):
        kept = let(kept, lambda ws: F.filter(ws, lambda w, i: F.array_position(F.transform(ws, lambda x: x["field"]), w["field"]) == i + 1))
    return pages.select(F.col(key).alias("id"), F.explode(kept).alias("w")).select("id", "w.*")


def value_length(fields: DataFrame, limit: int = MAX_VALUE_LENGTH) -> DataFrame:
    """Drop missing values and values of ``limit`` characters or more."""
    return fields.where(F.char_length("value") < limit)


def mapped_fields(fields: DataFrame, mapping: DataFrame) -> DataFrame:
    """Drop fields the index does not define."""
    names = mapping.select(F.col("name").alias("field"), F.lit(True).alias("_m"))
    return lookup_join(fields, names, ["field"], "inner").drop("_m")


def add_if_absent(fields: DataFrame) -> DataFrame:
    """One value per document and field: the first writer's."""
    return fields.groupBy("id", "field").agg(F.min_by("value", "rnk").alias("value"), F.min("rnk").alias("rnk"))


def add_values(fields: DataFrame, skip_null: bool = False, skip_empty: bool = False, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Every value of a field in writing order, numbered from 0; writes of one rank are ordered by their value's hash.

    Texts stay in their rows: they are no sort key.
    """
    kept = fields
    if skip_null or skip_empty:
        kept = kept.where("value is not null")
    if skip_empty:
        kept = kept.where("value <> ''")
    value = F.coalesce("value", F.lit(""))
    order = [("rnk", F.col("rnk")), ("mix", F.xxhash64(value)), ("md5", F.md5(F.encode(value, "UTF-8")))]
    numbered = rank_rows(kept, ["id", "field"], order, "pos", rows_per_bucket=rows_per_bucket)
    return numbered.withColumn("pos", (F.col("pos") - 1).cast("int"))


def add_list_values(lists: DataFrame, values: str = "values") -> DataFrame:
    """Values of list-typed writes: a first list is flattened, a later list is one value (as text)."""
    firsts = lists.groupBy("id", "field").agg(F.min("rnk").alias("rnk"))
    # joined on the write itself, so a field with very many writes is spread
    marked = lists.join(firsts.withColumn("_first", F.lit(True)), ["id", "field", "rnk"], "left")
    as_one = F.array(F.concat(F.lit("["), F.array_join(values, ", "), F.lit("]")))
    flat = F.when(F.col("_first"), F.col(values)).otherwise(as_one)
    return marked.select("id", "field", "rnk", F.posexplode(flat).alias("in_pos", "value"))


def doc_multimap(fields: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Field name -> values, one row per value with its place in the list."""
    return add_values(fields, skip_null=True, rows_per_bucket=rows_per_bucket).select("id", "field", "pos", "value")


def field_value(fields: DataFrame, field: str) -> DataFrame:
    """First value of one field per document."""
    return fields.where(F.col("field") == field).groupBy("id").agg(F.min_by("value", "rnk").alias("value"))


def remove_field(fields: DataFrame, field: str) -> DataFrame:
    return fields.where(F.col("field") != field)


def field_names(fields: DataFrame) -> DataFrame:
    return fields.select("id", "field").distinct()


def single_or_multi(fields: DataFrame, mapping: DataFrame) -> DataFrame:
    """Single-valued fields keep their first value, multi-valued ones all; unmapped means single."""
    kinds = mapping.select(F.col("name").alias("field"), "multi_valued")
    typed = lookup_join(fields, kinds, ["field"]).withColumn("multi_valued", F.coalesce("multi_valued", F.lit(False)))
    # a write is (id, field, rnk): each write of a multi-valued field is its own group
    return (
        typed.groupBy("id", "field", F.when(F.col("multi_valued"), F.col("rnk")).alias("_write"))
        .agg(F.min("rnk").alias("rnk"), F.min_by("value", "rnk").alias("value"))
        .drop("_write")
    )


def iso_instant(ts: Column) -> Column:
    """A timestamp as an ISO instant, seconds resolution, UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def with_weights(fields: DataFrame, doc_weight: Column | None = None, field_weight: Column | None = None) -> DataFrame:
    """Add document and field weights, 1.0 where none is given."""
    one = F.lit(1.0)
    return fields.withColumns(
        {
            "doc_weight": one if doc_weight is None else F.coalesce(doc_weight.cast("double"), one),
            "field_weight": one if field_weight is None else F.coalesce(field_weight.cast("double"), one),
        }
    )


def field_line(fields: DataFrame) -> DataFrame:
    """One rendered line per field value, brackets removed."""
    return fields.select(
        "id",
        "field",
        "rnk",
        F.translate(F.concat(F.lit("\t"), F.col("field"), F.lit(":\t"), F.col("value")), "[]", "").alias("line"),
    )


def doc_line(fields: DataFrame, names: list[str]) -> DataFrame:
    """One line per document over the named fields, first value each, brackets removed.

    The names bound the line: a document's values are picked, not collected.
    """
    picked = fields.where(F.col("field").isin(names)).groupBy("id").agg(
        *[F.min_by(F.when(F.col("field") == n, F.col("value")), F.when(F.col("field") == n, F.col("rnk"))).alias(n) for n in names]
    )
    parts = [F.when(F.col(n).isNotNull(), F.concat(F.lit(f"\t{n}:\t"), F.col(n))) for n in names]
    return picked.select("id", F.translate(F.concat_ws(", ", *parts), "[]", "").alias("line"))


def sink_rows(fields: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rows for the index: mapped fields only, single-valued fields cut to their first value."""
    return single_or_multi(mapped_fields(fields, mapping), mapping)


def batch_numbers(docs: DataFrame, partitions: int, batch: int = BATCH_DOCS, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add each document's push batch: partitions by id, ``batch`` documents at a time."""
    parted = docs.select("id").distinct().withColumn("part", partition_of(F.col("id"), partitions))
    ranked = rank_rows(parted, ["part"], [("id", F.col("id"))], "_r", rows_per_bucket=rows_per_bucket)
    return ranked.select("id", "part", F.floor((F.col("_r") - 1) / batch).cast("int").alias("batch_no"))
