"""Seed-line options as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlspark.functions.let import let

# Option names with their aliases and defaults.
OPTION_NAMES = {
    "log": ("-log", "-verbose"),
    "interval": ("-i", "--fetch-interval"),
    "priority": ("-p", "--fetch-priority"),
    "score": ("-s", "--score"),
    "depth": ("-d", "--depth"),
    "zone": ("-z", "--zone-id"),
    "follow_dom": ("-fd", "--follow-dom"),
    "keywords": ("-w", "--keywords"),
    "indexer": ("-idx", "--indexer-url"),
    "amin": ("-amin", "--anchor-min-length"),
    "amax": ("-amax", "--anchor-max-length"),
    "umin": ("-umin", "--url-min-length"),
    "umax": ("-umax", "--url-max-length"),
    "upre": ("-upre", "--url-prefix"),
    "ucon": ("-ucon", "--url-contains"),
    "upos": ("-upos", "--url-postfix"),
    "ureg": ("-ureg", "--url-regex"),
    "entity": ("-e", "--entity"),
    "entity_dom": ("-ed", "--entity-dom"),
    "collection": ("-c", "--collection"),
    "collection_dom": ("-cd", "--collection-dom"),
    "collection_item": ("-ci", "--collection-item"),
    "crawl_id": ("-crawlId",),
    "config": ("-config",),
}
HELP_NAMES = ("-h", "-help", "--help")
# Parsed option, its type and default.
OPTION_FIELDS = (
    ("log", "int", 0),
    ("interval_s", "bigint", 3600),
    ("priority", "int", 0),
    ("score", "int", 0),
    ("depth", "int", 1),
    ("zone", "string", "UTC"),
    ("follow_dom", "string", "body"),
    ("keywords", "string", None),
    ("indexer", "string", None),
    ("amin", "int", 5),
    ("amax", "int", 50),
    ("umin", "int", 10),
    ("umax", "int", 200),
    ("upre", "string", ""),
    ("ucon", "string", ""),
    ("upos", "string", ""),
    ("ureg", "string", ""),
    ("entity", "string", None),
    ("entity_dom", "string", "body"),
    ("collection", "string", None),
    ("collection_dom", "string", None),
    ("collection_item", "string", None),
    ("crawl_id", "string", None),
    ("config", "string", None),
    ("bad_options", "string", ""),
)

BLANK = r"[ \t]+"


def seed_url(line: Column) -> Column:
    """Url of a seed line: the text before the first blank or tab."""
    return F.coalesce(F.get(F.split(_stripped(line), BLANK, 2), F.lit(0)), F.lit(""))


def seed_args(line: Column) -> Column:
    """Arguments of a seed line: the text after the first run of blanks or tabs."""
    return F.coalesce(F.get(F.split(_stripped(line), BLANK, 2), F.lit(1)), F.lit(""))


def _stripped(line: Column) -> Column:
    return F.regexp_replace(F.coalesce(line, F.lit("")), r"^\s+|\s+$", "")


def option_value(args: Column, name: str) -> Column:
    """Value token that follows an option, null when the option is absent."""
    names = "|".join(OPTION_NAMES[name])
    return F.nullif(F.regexp_extract(args, rf"(?:^|[ \t])(?:{names})[ \t]+([^ \t]+)", 1), F.lit(""))


def parse_options(args: Column) -> Column:
    """All options of one seed line as a struct; what is missing or malformed has its default."""


    def field(name: str, kind: str, default) -> Column:
        if name == "interval_s":
            value = duration_seconds(option_value(args, "interval"))
        elif name == "bad_options":
            value = bad_options(args)
        else:
            value = option_value(args, name)
            value = value.try_cast("int") if kind == "int" else value
        return F.coalesce(value, F.lit(default).cast(kind)).alias(name)

    return F.struct(*[field(*f) for f in OPTION_FIELDS])


def default_options() -> Column:
    """The options a page without any has."""
    return F.struct(*[F.lit(default).cast(kind).alias(name) for name, kind, default in OPTION_FIELDS])


def bad_options(args: Column) -> Column:
    """Option names on the line that nobody defines, in order, joined by blanks."""
    known = sorted({n for names in OPTION_NAMES.values() for n in names} | set(HELP_NAMES))
    tokens = F.split(args, BLANK)
    unknown = F.filter(
        tokens,
        lambda t: t.rlike(r"^--?[A-Za-z]") & ~t.isin(known) & ~t.rlike(r"^-FF?[^=]+="),
    )
    return F.array_join(unknown, " ")


def field_extractors(args: Column, flag: str) -> Column:
    """``-Fname=path`` / ``-FFname=path`` options as a map; ``%`` in a path means a blank.

    The first writer of a name wins, so a repeated name does not fail the job.
    """
    pattern = F.lit(rf"(?:^|[ \t])-{flag}([^ \t=]+)=([^ \t]*)" if flag == "FF" else r"(?:^|[ \t])-F(?!F)([^ \t=]+)=([^ \t]*)")
    names = F.regexp_extract_all(args, pattern, 1)
    paths = F.transform(F.regexp_extract_all(args, pattern, 2), lambda p: F.replace(p, F.lit("%"), F.lit(" ")))

    def first_of_each(ns: Column) -> Column:
        zipped = F.arrays_zip(ns.alias("k"), paths.alias("v"))
        return F.map_from_entries(F.filter(zipped, lambda e, i: F.array_position(ns, e["k"]) == i + 1))

    return let(names, first_of_each)


# --- typed values ---------------------------------------------------------------------------

_ISO = r"(?i)^([+-]?)P(?:([0-9]+)D)?(?:T(?:([0-9]+)H)?(?:([0-9]+)M)?(?:([0-9]+)(?:[.][0-9]+)?S)?)?$"
_SHORT = r"(?i)^([0-9]+)(s|m|h|d)$"


def duration_seconds(text: Column) -> Column:
    """Seconds of ``PnDTnHnMnS`` or ``n[smhd]``; null when malformed."""

    def part(group: int, unit: int) -> Column:
        return F.coalesce(F.regexp_extract(text, _ISO, group).try_cast("bigint"), F.lit(0).cast("bigint")) * unit

    sign = F.when(F.regexp_extract(text, _ISO, 1) == "-", -1).otherwise(1)
    iso = sign * (part(2, 86400) + part(3, 3600) + part(4, 60) + part(5, 1))
    unit = F.lower(F.regexp_extract(text, _SHORT, 2))
    size = F.when(unit == "s", 1).when(unit == "m", 60).when(unit == "h", 3600).otherwise(86400)
    return (
        F.when(text.rlike(_ISO) & text.rlike("[0-9]"), iso)
        .when(text.rlike(_SHORT), F.regexp_extract(text, _SHORT, 1).try_cast("bigint") * size)
        .cast("bigint")
    )


def instant(text: Column) -> Column:
    """Instant text as a UTC timestamp without zone; malformed text is the epoch."""
    parsed = F.when(
        text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,9})?Z$"),
        F.regexp_replace(F.regexp_replace(text, "T", " "), "Z", "").try_cast("timestamp_ntz"),
    )
    return F.coalesce(parsed, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def int_pair(text: Column) -> Column:
    """``8,40`` as a struct of two ints; a malformed side is null."""
    parts = F.split(text, ",")
    return F.struct(
        F.get(parts, F.lit(0)).try_cast("int").alias("first"),
        F.get(parts, F.lit(1)).try_cast("int").alias("second"),
    )


def weighted_keywords(text: Column) -> Column:
    """``a^2,b`` as (keyword, weight) structs in text order; the later of two equal words wins."""
    parts = F.split(F.regexp_replace(F.replace(text, F.lit(" "), F.lit("")), ",+$", ""), ",")
    entries = F.transform(
        parts,
        lambda p: F.struct(
            F.when(_has_weight(p), F.substring_index(p, "^", 1)).otherwise(p).alias("keyword"),
            F.when(_has_weight(p), F.coalesce(F.regexp_extract(p, r"^[^^]+\^(.+)$", 1).try_cast("double"), F.lit(1.0)))
            .otherwise(1.0)
            .alias("weight"),
        ),
    )

    def last_of_each(es: Column) -> Column:
        return F.filter(
            es, lambda e, i: ~F.exists(F.slice(es, i + 2, F.size(es)), lambda later: later["keyword"] == e["keyword"])
        )

    return let(entries, last_of_each)


def _has_weight(part: Column) -> Column:
    return part.rlike(r"^[^^]+\^.+$")


def format_keywords(entries: Column) -> Column:
    """Keywords as ``k^w,…`` sorted by word, weights with at most one decimal (half to even)."""
    one = F.transform(
        F.array_sort(entries),
        lambda e: F.concat(
            e["keyword"], F.lit("^"), F.regexp_replace(F.bround(e["weight"], 1).cast("decimal(20,1)").cast("string"), "[.]0$", "")
        ),
    )
    return F.array_join(one, ",")


def options_line(url: Column, opts: Column, fields: Column, sub_fields: Column) -> Column:
    """Canonical text of a seed: url, then every non-empty option in declared order."""

    def item(flag: str, value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNotNull() & (text != ""), F.concat(F.lit(flag + " "), text))

    def dynamic(flag: str, entries: Column) -> Column:
        return F.array_join(
            F.transform(F.array_sort(F.map_entries(entries)), lambda e: F.concat(F.lit(flag), e["key"], F.lit("="), e["value"])),
            " ",
        )

    line = F.concat_ws(
        " ",
        F.nullif(url, F.lit("")),
        item("-log", opts["log"]),
        item("-i", iso_duration(opts["interval_s"])),
        item("-p", opts["priority"]),
        item("-s", opts["score"]),
        item("-d", opts["depth"]),
        item("-z", opts["zone"]),
        item("-fd", opts["follow_dom"]),
        item("-w", format_keywords(weighted_keywords(opts["keywords"]))),
        item("-idx", opts["indexer"]),
        item("-amin", opts["amin"]),
        item("-amax", opts["amax"]),
        item("-umin", opts["umin"]),
        item("-umax", opts["umax"]),
        item("-upre", opts["upre"]),
        item("-ucon", opts["ucon"]),
        item("-upos", opts["upos"]),
        item("-ureg", opts["ureg"]),
        item("-e", opts["entity"]),
        item("-ed", opts["entity_dom"]),
        F.nullif(dynamic("-F", fields), F.lit("")),
        item("-c", opts["collection"]),
        item("-cd", opts["collection_dom"]),
        item("-ci", opts["collection_item"]),
        F.nullif(dynamic("-FF", sub_fields), F.lit("")),
    )
    return F.regexp_replace(line, r"\s+", " ")


def iso_duration(seconds: Column) -> Column:
    """Seconds as ``PTnHnMnS``, the form duration options are printed in."""
    # a negative duration has its sign in front
    size = F.abs(seconds)
    hours = F.floor(size / 3600).cast("bigint")
    minutes = F.floor((size % 3600) / 60).cast("bigint")
    rest = size % 60

    def item(value: Column, unit: str) -> Column:
        return F.when(value != 0, F.concat(value.cast("string"), F.lit(unit))).otherwise("")

    return F.when(seconds == 0, F.lit("PT0S")).otherwise(
        F.concat(F.when(seconds < 0, F.lit("-PT")).otherwise("PT"), item(hours, "H"), item(minutes, "M"), item(rest, "S"))
    )
