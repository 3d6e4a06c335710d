"""Registered domains, suffix records and grouping keys of urls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions import urls as U
from crawlspark.operators.lookup import is_small, lookup_join, weight

HOST, DOMAIN, IP = "host", "domain", "ip"


def with_suffix(df: DataFrame, host: Column, suffixes: DataFrame, prefix: str = "suffix") -> DataFrame:
    """Add the longest known suffix below the first label of ``host`` as struct ``prefix``.

    A host of one label may be a suffix itself; an IPv4 address has none. Suffixes have few
    labels, so each possible length is one look-up join and no row is multiplied or shuffled.
    """
    # one pass over the suffixes proves their size and counts their labels
    depth, *size = suffixes.agg(F.max(F.size(F.split("domain", "[.]"))), *weight(suffixes)).first()
    depth, small = depth or 0, is_small(*size)
    attributes = [c for c in suffixes.columns if c != "domain"]
    out = df.withColumns({"_host": host, "_labels": F.split(host, "[.]")})
    for k in range(1, depth + 1):
        usable = ((F.size("_labels") > k) | ((F.size("_labels") == 1) & F.lit(k == 1))) & ~U.is_ipv4(F.col("_host"))
        out = out.withColumn(
            f"_c{k}", F.when(usable, F.array_join(F.slice("_labels", F.greatest(F.size("_labels") - k + 1, F.lit(1)), k), "."))
        )
        of_length = suffixes.where(F.size(F.split("domain", "[.]")) == k).select(
            F.col("domain").alias(f"_c{k}"),
            F.struct(F.col("domain"), *[F.col(a) for a in attributes]).alias(f"_s{k}"),
        )
        out = lookup_join(out, of_length, [f"_c{k}"], small=small)
    found = F.coalesce(*[F.col(f"_s{k}") for k in range(depth, 0, -1)]) if depth else F.lit(None)
    helpers = ["_host", "_labels"] + [f"_{p}{k}" for p in "cs" for k in range(1, depth + 1)]
    return out.withColumn(prefix, found).drop(*helpers)


def with_domain(df: DataFrame, url: Column, suffixes: DataFrame, name: str = "domain") -> DataFrame:
    """Add the registered domain: one label more than the longest known suffix.

    IPv4: itself. No known suffix: the last label. Null when the url is malformed.
    """
    host = F.regexp_replace(U.url_host(url), "[.]$", "")
    found = with_suffix(df.withColumn("_dh", host), F.col("_dh"), suffixes, "_suffix")
    labels = F.split("_dh", "[.]")
    keep = F.size(F.split(F.col("_suffix.domain"), "[.]")) + 1
    named = F.array_join(F.slice(labels, F.greatest(F.size(labels) - keep + 1, F.lit(1)), keep), ".")
    domain = (
        F.when(~U.is_valid_url(url), F.lit(None).cast("string"))
        .when(U.is_ipv4(F.col("_dh")), F.col("_dh"))
        .when(F.col("_suffix").isNull(), F.substring_index("_dh", ".", -1))
        .otherwise(named)
    )
    return found.withColumn(name, domain).drop("_dh", "_suffix")


def with_group(
    df: DataFrame,
    url: Column,
    mode: str = HOST,
    suffixes: DataFrame | None = None,
    host_ip: DataFrame | None = None,
    name: str = "group_key",
) -> DataFrame:
    """Add the grouping key of a url under a mode; ``''`` when malformed, null when unresolved by IP."""
    if mode == HOST:
        return df.withColumn(name, U.url_host(url))
    if mode == DOMAIN:
        return with_domain(df, url, suffixes, name).withColumn(name, F.coalesce(F.col(name), F.lit("")))
    ips = host_ip.select(F.col("host").alias("_ih"), F.col("ip").alias("_ip"))
    found = lookup_join(df.withColumn("_ih", U.url_host(url)), ips, ["_ih"])
    return found.withColumn(name, F.when(F.col("_ih") == "", F.lit("")).otherwise(F.col("_ip"))).drop("_ih", "_ip")


def with_same_domain(df: DataFrame, left: Column, right: Column, suffixes: DataFrame, name: str = "same_domain") -> DataFrame:
    """Whether two urls share a registered domain, ignoring case."""
    both = with_domain(with_domain(df, left, suffixes, "_d1"), right, suffixes, "_d2")
    return both.withColumn(name, F.lower("_d1") == F.lower("_d2")).drop("_d1", "_d2")


def with_partition(
    df: DataFrame,
    url: Column,
    partitions: int,
    mode: str = HOST,
    run_seed: int = 0,
    suffixes: DataFrame | None = None,
    host_ip: DataFrame | None = None,
    name: str = "part",
) -> DataFrame:
    """Add the partition number of a url's group.

    A host without a known IP falls back to the url's hash; a malformed url is spread by hash.
    """
    grouped = with_group(df, url, mode, suffixes, host_ip, "_g")
    key = F.coalesce(F.col("_g"), url)
    part = F.when(U.is_valid_url(url), U.partition_of(key, partitions, run_seed)).otherwise(
        F.pmod(F.xxhash64(url), F.lit(partitions)).cast("int")
    )
    return grouped.withColumn(name, part).drop("_g")


def lay_out(df: DataFrame, part: str = "part") -> DataFrame:
    """Co-locate rows by partition number; AQE cuts a part that is far larger than the others."""
    return df.hint("rebalance", F.col(part))


def choose_representative(df: DataFrame, src: Column, dst: Column, temporary: Column, suffixes: DataFrame, name: str = "chosen") -> DataFrame:
    """Add the url that stands for a redirect from ``src`` to ``dst``."""
    both = with_domain(with_domain(df, src, suffixes, "_sd"), dst, suffixes, "_dd")

    def depth(file: Column) -> Column:
        # trailing separators open no new segment
        return F.size(F.split(F.regexp_replace(file, "/+$", ""), "/"))

    s_file, d_file = U.url_file(src), U.url_file(dst)
    s_root, d_root = s_file.isin("", "/"), d_file.isin("", "/")
    s_host, d_host = U.url_host(src), U.url_host(dst)
    shorter_file = (depth(d_file) < depth(s_file)) | (
        (depth(d_file) == depth(s_file)) & (F.length(d_file) < F.length(s_file))
    )
    fewer_labels = F.size(U.label_array(d_host)) < F.size(U.label_array(s_host))
    take_src = (
        F.when(~(U.is_valid_url(src) & U.is_valid_url(dst)), False)
        .when(F.col("_sd") != F.col("_dd"), False)
        .when(~temporary, s_root)
        .when(s_root != d_root, s_root)
        .when(~s_root & (s_host == d_host), ~shorter_file)
        .otherwise(~fewer_labels)
    )
    return both.withColumn(name, F.when(take_src, src).otherwise(dst)).drop("_sd", "_dd")
