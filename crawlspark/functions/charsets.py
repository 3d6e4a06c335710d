"""Character set clues: header, meta tags, byte order mark."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_CHARSET = "windows-1252"

# Supported charset names by any of their usual spellings -> the name reported.
# Mislabelled western, Korean and Chinese sets resolve to the superset they are usually meant as.
SUPPORTED = {
    "utf-8": "utf-8",
    "utf8": "utf-8",
    "unicode-1-1-utf-8": "utf-8",
    "utf-16": "utf-16",
    "utf16": "utf-16",
    "utf-16le": "utf-16le",
    "utf-16be": "utf-16be",
    "utf-32": "utf-32",
    "us-ascii": "us-ascii",
    "ascii": "us-ascii",
    "iso-8859-1": "windows-1252",
    "iso8859-1": "windows-1252",
    "iso8859_1": "windows-1252",
    "iso_8859-1": "windows-1252",
    "latin1": "windows-1252",
    "l1": "windows-1252",
    "cp819": "windows-1252",
    "iso-8859-2": "iso-8859-2",
    "latin2": "iso-8859-2",
    "iso-8859-3": "iso-8859-3",
    "iso-8859-4": "iso-8859-4",
    "iso-8859-5": "iso-8859-5",
    "iso-8859-6": "iso-8859-6",
    "iso-8859-7": "iso-8859-7",
    "iso-8859-8": "iso-8859-8",
    "iso-8859-9": "iso-8859-9",
    "iso-8859-13": "iso-8859-13",
    "iso-8859-15": "iso-8859-15",
    "latin-9": "iso-8859-15",
    "windows-1250": "windows-1250",
    "cp1250": "windows-1250",
    "windows-1251": "windows-1251",
    "cp1251": "windows-1251",
    "windows-1252": "windows-1252",
    "cp1252": "windows-1252",
    "windows-1253": "windows-1253",
    "windows-1254": "windows-1254",
    "windows-1255": "windows-1255",
    "windows-1256": "windows-1256",
    "windows-1257": "windows-1257",
    "windows-1258": "windows-1258",
    "koi8-r": "koi8-r",
    "koi8-u": "koi8-u",
    "ibm866": "ibm866",
    "cp866": "ibm866",
    "gbk": "gbk",
    "cp936": "gbk",
    "gb2312": "gb2312",
    "euc-cn": "gb2312",
    "x-euc-cn": "gb18030",
    "gb18030": "gb18030",
    "big5": "big5",
    "big5-hkscs": "big5-hkscs",
    "euc-jp": "euc-jp",
    "shift_jis": "shift_jis",
    "shift-jis": "shift_jis",
    "sjis": "shift_jis",
    "windows-31j": "windows-31j",
    "iso-2022-jp": "iso-2022-jp",
    "euc-kr": "x-windows-949",
    "euckr": "x-windows-949",
    "ks_c_5601-1987": "x-windows-949",
    "x-windows-949": "x-windows-949",
    "ms949": "x-windows-949",
    "tis-620": "tis-620",
}

def canonical_charset(name: Column) -> Column:
    """Reported name of a supported charset, null for anything else."""
    table = F.str_to_map(F.lit(";".join(f"{k}={v}" for k, v in SUPPORTED.items())), F.lit(";"), F.lit("="))
    return F.try_element_at(table, F.lower(name))


def header_charset(content_type: Column) -> Column:
    """``charset=`` value of a content-type header."""
    raw = F.trim(F.regexp_extract(content_type, r"charset=([^;]*)", 1))
    return F.nullif(F.trim(F.regexp_replace(raw, r'^"(.+)"$', "$1")), F.lit(""))


def meta_charset(metas: Column) -> Column:
    """Charset of the first content type among parsed meta tags, else of the first ``charset`` attribute."""
    types = F.filter(metas, lambda m: (m["equiv"] == "content-type") & m["content"].isNotNull())
    declared = header_charset(F.lower(F.get(types, F.lit(0))["content"]))
    named = F.trim(F.get(F.filter(metas, lambda m: m["charset"].isNotNull()), F.lit(0))["charset"])
    return F.coalesce(declared, F.nullif(named, F.lit("")))


def mark_charset(content: Column) -> Column:
    """Charset named by the byte order mark of binary content."""
    mark = F.hex(F.substring(content, 1, 3))
    return (
        F.when(mark == "EFBBBF", F.lit("UTF-8"))
        .when(mark.startswith("FFFE"), F.lit("UTF-16LE"))
        .when(mark.startswith("FEFF"), F.lit("UTF-16BE"))
    )


def decode(content: Column, charset: Column) -> Column:
    """Text of binary content in a charset named as in SUPPORTED, without a byte order mark.

    Malformed bytes become U+FFFD; null where the JDK has no such charset. The two usual sets are built-in
    expressions; the others are percent-encoded for the JDK's decoder.
    """
    codes = [n for n in range(128, 160) if n not in (129, 141, 143, 144, 157)]
    western = F.translate(F.decode(content, "ISO-8859-1"), "".join(map(chr, codes)), bytes(codes).decode("cp1252"))
    percent = F.regexp_replace(F.hex(content), "(..)", "%$1")
    other = F.try_reflect(F.lit("java.net.URLDecoder"), F.lit("decode"), percent, charset)
    text = F.when(charset == "utf-8", F.make_valid_utf8(content.cast("string"))).when(charset == DEFAULT_CHARSET, western).otherwise(other)
    return F.regexp_replace(text, "^\ufeff", "")
