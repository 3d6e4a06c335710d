"""URL columns: validity, parts, resolution, keys, IDN and grouping hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlspark.functions.let import let

# Schemes a url may start with.
KNOWN_SCHEMES = "https?|ftp|file|jar|mailto"

_LEAD = r"^[\x00-\x20]*"
_SCHEME = _LEAD + r"[A-Za-z][A-Za-z0-9+.-]*:"
_VALID = _LEAD + r"(?i)(" + KNOWN_SCHEMES + "):"
# possessive: text before an "@" is never read as host and port
_USERINFO = r"(?:[^/?#@]*@)?+"
_HOST = _SCHEME + "//" + _USERINFO + r"(\[[^\]/?#]*\]|[^:/?#\[]*)"
_PORT = _SCHEME + "//" + _USERINFO + r"(?:\[[^\]/?#]*\]|[^:/?#\[]*):([0-9]+)"
_BAD_PORT = _SCHEME + "//" + _USERINFO + r"(?:\[[^\]/?#]*\]|[^:/?#\[]*):[0-9]*[^0-9/?#]"
_IPV4 = r"^([0-9]{1,3}[.]){3}[0-9]{1,3}$"
_ABSOLUTE = r"^[A-Za-z][A-Za-z0-9.+-]*:"
_BLANKS = "".join(chr(c) for c in range(33))


def is_valid_url(url: Column) -> Column:
    """True when the url starts with a known scheme and its port, if any, is a number."""
    return F.coalesce(url.rlike(_VALID) & ~url.rlike(_BAD_PORT), F.lit(False))


def is_ipv4(host: Column) -> Column:
    return host.rlike(_IPV4)


def url_host(url: Column) -> Column:
    """Host of a url as written, ``''`` when the url does not parse."""
    return F.when(is_valid_url(url), F.regexp_extract(url, _HOST, 1)).otherwise(F.lit(""))


def url_hostname(url: Column, default: Column | None = None) -> Column:
    """Lower-cased host; ``default`` (or null) when the url is malformed."""
    fallback = F.lit(None).cast("string") if default is None else default
    return F.when(is_valid_url(url), F.lower(F.regexp_extract(url, _HOST, 1))).otherwise(fallback)


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _LEAD + r"([A-Za-z][A-Za-z0-9+.-]*):", 1))


def url_origin(url: Column) -> Column:
    """Scheme and authority, nothing after it."""
    return F.regexp_extract(url, _LEAD + r"([A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?)", 1)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, _SCHEME + r"(?://[^/?#]*)?([^?#]*)", 1)


def url_file(url: Column) -> Column:
    """Path and query, without the fragment."""
    return F.regexp_extract(url, _SCHEME + r"(?://[^/?#]*)?([^#]*)", 1)


def url_page(url: Column) -> Column:
    """Lower-cased url without its query; the fragment stays. Null when malformed."""
    low = F.lower(url)
    return F.when(is_valid_url(url), F.regexp_replace(low, r"^([^?#]*)[?][^#]*", "$1"))


def host_labels(url: Column) -> Column:
    """Host labels; an IPv4 address stays in one piece, trailing empty labels are dropped."""
    host = url_host(url)
    return F.when(is_ipv4(host), F.array(host)).otherwise(label_array(host))


def label_array(host: Column) -> Column:
    return F.split(F.regexp_replace(host, r"[.]+$", ""), r"[.]")


def group_or_default(group: Column, default: Column) -> Column:
    """A group key, replaced by ``default`` when it is empty or missing."""
    return F.coalesce(F.nullif(group, F.lit("")), default)


# --- row keys -------------------------------------------------------------------------------

_KEY = r"^(\[[^\]/?#]*\]|[^:/?#\[]*):([A-Za-z][A-Za-z0-9+.-]*)(?::([0-9]+))?(.*)$"


def reverse_key(url: Column) -> Column:
    """Row key: reversed host labels ``:`` scheme [``:`` port] rest.

    Neighbouring keys share a domain, so a table sorted by key keeps a site together.
    """
    host = F.regexp_extract(url, _HOST, 1)
    port = F.regexp_extract(url, _PORT, 1)
    rest = F.regexp_extract(url, _SCHEME + r"(?://[^/?#]*)?([\s\S]*)$", 1)
    labels = F.when(host.startswith("["), host).otherwise(_reverse_labels(host))
    return F.when(
        is_valid_url(url),
        F.concat(labels, F.lit(":"), url_scheme(url), F.when(port != "", F.concat(F.lit(":"), port)).otherwise(""), rest),
    )


def unreverse_key(key: Column) -> Column:
    """The url a row key stands for."""
    host = F.regexp_extract(key, _KEY, 1)
    port = F.regexp_extract(key, _KEY, 3)
    return F.concat(
        F.regexp_extract(key, _KEY, 2),
        F.when(host != "", F.lit("://")).otherwise(":"),
        F.when(host.startswith("["), host).otherwise(_reverse_labels(host)),
        F.when(port != "", F.concat(F.lit(":"), port)).otherwise(""),
        F.regexp_extract(key, r"^(?:\[[^\]/?#]*\]|[^:/?#\[]*):[A-Za-z][A-Za-z0-9+.-]*(?::[0-9]+)?([\s\S]*)$", 1),
    )


def _reverse_labels(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"[.]")), ".")


# --- resolution -----------------------------------------------------------------------------


def base_parts(base: Column) -> Column:
    """The parts of a base url that resolution needs, computed once per page, not once per link."""
    return F.when(
        is_valid_url(base),
        F.struct(
            url_scheme(base).alias("scheme"),
            url_origin(base).alias("origin"),
            url_path(base).alias("path"),
            F.regexp_extract(base, r"^[^?#]*([?][^#]*)", 1).alias("query"),
            F.regexp_extract(base, r"(#[\s\S]*)$", 1).alias("ref"),
        ),
    )


def resolve(base: Column, target: Column) -> Column:
    """Absolute url of ``target`` seen from ``base`` (a :func:`base_parts` struct).

    Null when the base is malformed or the target has an unknown scheme. A target that is a pure
    query keeps the last path segment of the base; dot segments go away on relative paths only.
    """
    scheme, origin, path = base["scheme"], base["origin"], base["path"]
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    query_only = F.when(path == "", F.lit("/")).otherwise(drop_dot_segments(path))

    def seen(t: Column) -> Column:
        rel_path = F.regexp_extract(t, r"^([^?#]*)", 1)
        tail = F.regexp_extract(t, r"^[^?#]*([\s\S]*)$", 1)
        joined = F.when(path == "", F.concat(F.lit("/"), rel_path)).otherwise(
            drop_dot_segments(F.concat(folder, rel_path))
        )
        lowered = F.concat(F.lower(F.regexp_extract(t, r"^([^:]*)", 1)), F.regexp_extract(t, r"^[^:]*([\s\S]*)$", 1))
        return (
            F.when(t == "", F.concat(origin, path, base["query"], base["ref"]))
            .when(t.startswith("//"), F.concat(scheme, F.lit(":"), t))
            .when(t.startswith("/"), F.concat(origin, t))
            .when(t.startswith("?"), F.concat(origin, query_only, t))
            .when(t.startswith("#"), F.concat(origin, path, base["query"], t))
            .when(t.rlike(_ABSOLUTE), F.when(is_valid_url(t), lowered))
            .otherwise(F.concat(origin, joined, tail))
        )

    def cleaned(t: Column) -> Column:
        # "http:page" without slashes under an http base is a relative path
        own = F.lower(F.regexp_extract(t, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
        return F.when((own == scheme) & ~t.rlike(r"^[^:]+:/"), F.regexp_replace(t, r"^[^:]*:", "")).otherwise(t)

    trimmed = F.btrim(target, F.lit(_BLANKS))
    return F.when(base.isNotNull(), let(let(trimmed, cleaned), seen))


def drop_dot_segments(path: Column) -> Column:
    """Remove ``.`` and ``..`` segments of an absolute path; ``..`` above the root stays."""

    def clean(segments: Column) -> Column:
        kept = F.aggregate(
            F.filter(segments, lambda s: s != "."),
            F.array().cast("array<string>"),
            lambda acc, s: F.when(
                (s == "..") & (F.size(acc) > 1) & (F.get(acc, F.size(acc) - 1) != ".."),
                F.slice(acc, 1, F.size(acc) - 1),
            ).otherwise(F.concat(acc, F.array(s))),
        )
        last = F.get(segments, F.size(segments) - 1)

        def ended(acc: Column) -> Column:
            open_end = (last == ".") | ((last == "..") & (F.get(acc, F.size(acc) - 1) != ".."))
            return F.concat(F.array_join(acc, "/"), F.when(open_end, F.lit("/")).otherwise(""))

        return let(kept, ended)

    return let(path, lambda p: F.when(p.rlike(r"/\.{1,2}(/|$)"), let(F.split(p, "/"), clean)).otherwise(p))


# --- internationalized hosts ----------------------------------------------------------------

# Characters a URI may not hold in its path or query, "%" first.
_QUOTED = "% \"<>\\^`{|}"


def to_ascii(url: Column) -> Column:
    """Url with a punycode host; no host: unchanged; malformed: null.

    The conversion is the JDK's own, called only for hosts that need it.
    """
    host = url_host(url)
    needs = host.rlike(r"[^\x00-\x7F]") | host.rlike(r"[^.]{64,}")
    idn = F.when(needs, F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), host)).otherwise(host)
    return _with_host(url, host, idn, quote=True)


def to_unicode(url: Column) -> Column:
    """Url with its punycode labels decoded; no host: unchanged; malformed: null."""
    host = url_host(url)
    idn = F.when(
        host.rlike(r"(?i)(^|[.])xn--"), F.try_reflect(F.lit("java.net.IDN"), F.lit("toUnicode"), host)
    ).otherwise(host)
    return _with_host(url, host, idn, quote=False)


def _with_host(url: Column, host: Column, new_host: Column, quote: bool) -> Column:
    user = F.regexp_extract(url, _SCHEME + r"//([^/?#@]*@)", 1)
    port = F.regexp_extract(url, _PORT, 1)
    rest = F.regexp_extract(url, _SCHEME + r"(?://[^/?#]*)?([\s\S]*)$", 1)
    if quote:
        clean = rest
        for ch in _QUOTED:
            clean = F.replace(clean, F.lit(ch), F.lit(f"%{ord(ch):02X}"))
        rest = F.when(rest.rlike(r'[% "<>\\^`{|}]'), clean).otherwise(rest)
    built = F.concat(
        url_scheme(url), F.lit("://"), user, new_host, F.when(port != "", F.concat(F.lit(":"), port)).otherwise(""), rest
    )
    return F.when(~is_valid_url(url), F.lit(None).cast("string")).when(host == "", url).otherwise(built)


# --- grouping hash --------------------------------------------------------------------------


def string_hash(text: Column) -> Column:
    """The 32-bit polynomial string hash (base 31 over UTF-16 units) as a signed int."""

    def fold(items: Column, unit) -> Column:
        wrapped = F.aggregate(
            items, F.lit(0).cast("bigint"), lambda h, u: (h * 31 + unit(u)).bitwiseAND(F.lit(4294967295))
        )
        return let(wrapped, lambda h: F.when(h >= 2147483648, h - 4294967296).otherwise(h).cast("int"))

    def hashed(t: Column) -> Column:
        units = F.regexp_extract_all(F.hex(F.encode(t, "UTF-16BE")), F.lit("(.{4})"), 1)
        return (
            F.when(t == "", 0)
            .when(t.rlike(r"[^\x00-\x7F]"), fold(units, lambda u: F.conv(u, 16, 10).cast("bigint")))
            .otherwise(fold(F.split(t, ""), lambda c: F.ascii(c).cast("bigint")))
        )

    return let(text, hashed)


def partition_of(group: Column, partitions: int, run_seed: int = 0) -> Column:
    """Partition number of a group key; the run seed moves groups between runs."""
    if partitions == 1:
        return F.lit(0)
    mixed = string_hash(group).bitwiseXOR(F.lit(run_seed)).bitwiseAND(F.lit(2147483647))
    return (mixed % partitions).cast("int")
