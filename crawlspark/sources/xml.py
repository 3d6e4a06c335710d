"""XML dimensions: the index mapping and the domain suffix table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_KEY = "id"
DEFAULT_STATUS = "IN_USE"
DEFAULT_BOOST = 1.0


_FIELD = (
    "struct<_name:string,_type:string,_indexed:string,_stored:string,_required:string,_multiValued:string,_VALUE:string>"
)
_ENTRY = "struct<_domain:string,status:string,boost:string,country:string>"


def read_index_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Index fields: name, type, indexed, stored, required, multi_valued; missing flags are false."""
    return _index_fields(spark.read.format("xml").schema(_columns(_FIELD)).option("rowTag", "field").load(path))


def parse_index_fields(texts: DataFrame, text: str = "value") -> DataFrame:
    """Index fields from one ``<field>`` element per row."""
    return _index_fields(texts.select(F.from_xml(text, _FIELD).alias("f")).select("f.*"))


def _columns(struct: str) -> str:
    return struct[len("struct<") : -1].replace(":", " ")


def _index_fields(rows: DataFrame) -> DataFrame:
    def flag(name: str) -> Column:
        return F.coalesce(F.lower(name) == "true", F.lit(False))

    return rows.select(
        F.col("_name").alias("name"),
        F.col("_type").alias("type"),
        flag("_indexed").alias("indexed"),
        flag("_stored").alias("stored"),
        flag("_required").alias("required"),
        flag("_multiValued").alias("multi_valued"),
    )


def read_unique_key(spark: SparkSession, path: str) -> DataFrame:
    """The one unique key the mapping names; none or several mean ``id``."""
    keys = spark.read.format("xml").schema("_VALUE string, _name string").option("rowTag", "uniqueKey").load(path)
    return keys.agg(
        F.when(F.count(F.lit(1)) == 1, F.trim(F.max("_VALUE"))).otherwise(F.lit(DEFAULT_KEY)).alias("unique_key")
    )


def read_suffixes(spark: SparkSession, path: str) -> DataFrame:
    """Domain suffixes: domain, status, boost, type, country from the four lists of the file."""
    listed = f"struct<tld:array<{_ENTRY}>>"
    schema = (
        f"tlds struct<itlds:{listed},gtlds:{listed},cctlds:{listed}>, "
        "suffixes struct<suffix:array<struct<_domain:string,status:string,boost:string>>>"
    )
    doc = spark.read.format("xml").schema(schema).option("rowTag", "domains").load(path)

    def entries(items: str, kind: str | None) -> DataFrame:
        return _suffix_rows(doc.select(F.explode(items).alias("e")), kind)

    return (
        entries("tlds.itlds.tld", "INFRASTRUCTURE")
        .unionByName(entries("tlds.gtlds.tld", "GENERIC"))
        .unionByName(entries("tlds.cctlds.tld", "COUNTRY"))
        .unionByName(entries("suffixes.suffix", None))
    )


def parse_suffixes(texts: DataFrame, kind: str | None, text: str = "value") -> DataFrame:
    """Suffixes of one list from one element per row."""
    return _suffix_rows(texts.select(F.from_xml(text, _ENTRY).alias("e")), kind)


def _suffix_rows(entries: DataFrame, kind: str | None) -> DataFrame:
    country = F.trim("e.country") if kind == "COUNTRY" else F.lit(None).cast("string")
    return entries.select(
        F.col("e._domain").alias("domain"),
        F.coalesce(F.trim("e.status"), F.lit(DEFAULT_STATUS)).alias("status"),
        F.coalesce(F.trim("e.boost").try_cast("double"), F.lit(DEFAULT_BOOST)).alias("boost"),
        F.lit(kind).cast("string").alias("type"),
        country.alias("country"),
    )
