"""Content type resolution: declared type, url extension, content prefix."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlspark.functions.let import let

OCTET_STREAM = "application/octet-stream"
PLAIN_TEXT = "text/plain"

# File extension -> content type.
BY_EXTENSION = {
    "html": "text/html",
    "htm": "text/html",
    "xhtml": "application/xhtml+xml",
    "xml": "application/xml",
    "rss": "application/rss+xml",
    "atom": "application/atom+xml",
    "txt": "text/plain",
    "css": "text/css",
    "csv": "text/csv",
    "js": "application/javascript",
    "json": "application/json",
    "pdf": "application/pdf",
    "rtf": "application/rtf",
    "doc": "application/msword",
    "xls": "application/vnd.ms-excel",
    "ppt": "application/vnd.ms-powerpoint",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "zip": "application/zip",
    "gz": "application/gzip",
    "tar": "application/x-tar",
    "gif": "image/gif",
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "png": "image/png",
    "svg": "image/svg+xml",
    "ico": "image/vnd.microsoft.icon",
    "mp3": "audio/mpeg",
    "mp4": "video/mp4",
    "swf": "application/x-shockwave-flash",
}

# Start of the content -> content type (text starts are compared in lower case).
BY_TEXT_PREFIX = {
    "<!doctype html": "text/html",
    "<html": "text/html",
    "<head": "text/html",
    "<title": "text/html",
    "<body": "text/html",
    "<?xml": "application/xml",
    "<rss": "application/rss+xml",
    "%pdf-": "application/pdf",
    "{\\rtf": "application/rtf",
}
BY_HEX_PREFIX = {
    "504B0304": "application/zip",
    "1F8B": "application/gzip",
    "47494638": "image/gif",
    "FFD8FF": "image/jpeg",
    "89504E47": "image/png",
}


def clean_type(declared: Column) -> Column:
    """Declared type up to its first ``;``."""
    return F.trim(F.substring_index(declared, ";", 1))


def resolve_type(declared: Column, url: Column, content: Column) -> Column:
    """Content type: the declared one if known, else by extension; the content's start overrides both.

    A start that only says plain text or nothing overrides nothing. ``content`` is binary.
    """
    known = sorted(set(BY_EXTENSION.values()) | set(BY_TEXT_PREFIX.values()) | set(BY_HEX_PREFIX.values()))
    cleaned = F.lower(clean_type(declared))
    by_header = F.when(cleaned.isin([k for k in known if k != OCTET_STREAM]), cleaned)
    table = F.str_to_map(F.lit(";".join(f"{k}={v}" for k, v in BY_EXTENSION.items())), F.lit(";"), F.lit("="))
    extension = F.lower(F.regexp_extract(url, r"^[^?#]*//[^/?#]*/[^?#]*[.]([A-Za-z0-9]+)(?:[?#].*)?$", 1))
    by_url = F.try_element_at(table, extension)
    return F.coalesce(by_content(content), by_header, by_url, F.lit(OCTET_STREAM))


def by_content(content: Column) -> Column:
    """Type named by the start of the content, null when it says nothing.

    A byte order mark, white space and comments before the first markup don't count, however long they are.
    """
    text = F.regexp_replace(F.decode(content, "ISO-8859-1"), r"(?s)^(?:\xEF\xBB\xBF|\s++|<!--.*?-->)*+", "")
    code = F.hex(F.substring(content, 1, 4))

    def named(start: Column) -> Column:
        chain = F
        for prefix, mime in BY_TEXT_PREFIX.items():
            chain = chain.when(start.startswith(prefix), F.lit(mime))
        for prefix, mime in BY_HEX_PREFIX.items():
            chain = chain.when(code.startswith(prefix), F.lit(mime))
        return chain

    longest = max(map(len, BY_TEXT_PREFIX))
    return let(F.lower(F.substring(text, 1, longest)), named)
