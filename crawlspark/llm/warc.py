"""WARC archives as a PySpark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading plans one partition per archive file. Equality, membership, prefix and null predicates on the record type and
the other header columns are pushed into the reader; ``header.<Name>`` options ask for any other header's value. A
record's headers are parsed first. If a predicate rejects it, or the read schema has no ``payload`` column, what
follows is not decoded: plain archives are sought past the block, compressed ones past the member, whose length
the writer leaves in a gzip extra field (members without one are inflated to find their end).

Writing makes one or more files per task, one gzip member per record. Files get their final names when the driver
commits, so attempts of lost tasks are never read.

``archive`` writes a table of pages, with revisit records for payloads that an earlier page has; ``records`` reads such
archives back.

Defined cases: a null payload is empty; a null page_id or url leaves its header out and reads as null; line breaks in
urls are percent-encoded; among equal payloads of at least 100 bytes all rows with the smallest page_id are
responses, null ids are revisits (if all ids are null, all rows are responses); an empty table gives an empty archive;
other columns are not archived.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
    WriterCommitMessage,
)

from crawlspark.llm.common import table
from crawlspark.session import work_dir

#: read columns that are one header each; the rest are headers (all of them), content_length and payload
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "date": "WARC-Date",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "page_id": "X-Page-Id",
    "payload_bytes": "X-Payload-Length",
}
NUMBERS = ("page_id", "payload_bytes")
SCHEMA = ", ".join(f"{c} {'bigint' if c in NUMBERS else 'string'}" for c in HEADERS) + ", content_length bigint, headers map<string,string>, payload binary"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
FILE_BYTES, LEAST_REVISIT, READ_AHEAD = 128 << 20, 100, 4096


class Files(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(dict(self.options), schema)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(dict(self.options))


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


class Archive(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema):
        self.path = options["path"]
        self.columns = [f.name for f in schema.fields]
        self.wanted: list[tuple[str, str, Any]] = []
        # option names arrive in lower case; header names don't depend on case
        self.headers = {k[len("header.") :].lower(): v for k, v in options.items() if k.lower().startswith("header.")}

    def pushFilters(self, filters):
        for f in filters:
            kind, attribute = type(f), getattr(f, "attribute", ())
            column = attribute[0] if len(attribute) == 1 else None
            if column in HEADERS and kind in (EqualTo, In, StringStartsWith, IsNull, IsNotNull):
                self.wanted.append((column, kind.__name__, getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list[Archive]:
        fs, root = file_system(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        names = sorted(i.path for i in found if i.is_file and re.search(r"\.warc(\.gz)?$", i.path) and not i.base_name.startswith((".", "_")))
        return [Archive(n) for n in names] or [Archive("")]

    def accepts(self, row: dict[str, Any], headers: dict[str, str]) -> bool:
        for column, kind, value in self.wanted:
            have = row[column]
            if kind == "IsNull":
                ok = have is None
            elif have is None:
                ok = False
            else:
                ok = {"EqualTo": lambda: have == value, "In": lambda: have in value, "StringStartsWith": lambda: have.startswith(value), "IsNotNull": lambda: True}[kind]()
            if not ok:
                return False
        return all(headers.get(k) == v for k, v in self.headers.items()) if self.headers else True

    def read(self, partition: Archive) -> Iterator[tuple]:
        if not partition.value:
            return
        fs, _ = file_system(self.path)
        with fs.open_input_file(partition.value) as file:
            for record in members(file) if partition.value.endswith(".gz") else blocks(file):
                named = {k.lower(): v for k, v in record.headers}
                row = {c: number(named.get(h.lower())) if c in NUMBERS else named.get(h.lower()) for c, h in HEADERS.items()}
                if not self.accepts(row, named):
                    continue
                row["content_length"], row["headers"] = int(named["content-length"]), dict(record.headers)
                if "payload" in self.columns:
                    row["payload"] = entity(record.block(), named)
                yield tuple(row[c] for c in self.columns)


def number(value: str | None) -> int | None:
    return int(value) if value is not None and re.fullmatch(r"-?\d+", value) else None


def entity(block: bytes, headers: dict[str, str]) -> bytes:
    """The payload of a block: what follows the protocol's own headers, if it has some."""
    if "application/http" in headers.get("content-type", ""):
        return block.partition(b"\r\n\r\n")[2]
    return block


class Record:
    """Headers, parsed; the block is fetched only when asked for."""

    def __init__(self, head: bytes, block):
        lines = re.sub(rb"\r\n[ \t]+", b" ", head).decode("utf-8", "replace").split("\r\n")[1:]
        self.headers = [(k.strip(), v.strip()) for k, _, v in (line.partition(":") for line in lines)]
        self._block = block

    def block(self) -> bytes:
        return self._block(self.length())

    def length(self) -> int:
        return next(int(v) for k, v in self.headers if k.lower() == "content-length")


def blocks(file) -> Iterator[Record]:
    """Records of a plain archive."""
    at, size = 0, file.size()
    while at < size:
        file.seek(at)
        data = file.read(READ_AHEAD)
        skip = len(data) - len(data.lstrip(b"\r\n"))
        while b"\r\n\r\n" not in data[skip:]:
            more = file.read(READ_AHEAD)
            if not more:
                if data.strip():
                    raise ValueError(f"an unfinished record at byte {at}")
                return
            data += more
            skip = len(data) - len(data.lstrip(b"\r\n"))
        head = data[skip : data.index(b"\r\n\r\n", skip)]
        start = at + skip + len(head) + 4

        def block(length: int, start=start) -> bytes:
            file.seek(start)
            return file.read(length)

        record = Record(head, block)
        yield record
        at = start + record.length()


def members(file) -> Iterator[Record]:
    """Records of a compressed archive, one gzip member each."""
    at, size = 0, file.size()
    while at < size:
        file.seek(at)
        inflate, data, used = zlib.decompressobj(31), b"", 0
        first = file.read(READ_AHEAD)
        length = member_length(first)
        pending = first
        while b"\r\n\r\n" not in data.lstrip(b"\r\n"):
            if not pending:
                raise ValueError(f"an unfinished record at byte {at}")
            used += len(pending)
            data += inflate.decompress(pending)
            pending = file.read(READ_AHEAD) if b"\r\n\r\n" not in data.lstrip(b"\r\n") else b""
        data = data.lstrip(b"\r\n")
        head, _, rest = data.partition(b"\r\n\r\n")
        parts = [rest]
        end = [at + length if length else None]

        def finish(at=at, used=used, inflate=inflate, parts=parts, end=end) -> None:
            position = at + used
            while not inflate.eof:
                file.seek(position)
                more = file.read(1 << 20)
                if not more:
                    raise ValueError(f"an unfinished record at byte {at}")
                position += len(more)
                parts.append(inflate.decompress(more))
            end[0] = position - len(inflate.unused_data)

        def block(size: int, parts=parts, finish=finish) -> bytes:
            finish()
            return b"".join(parts)[:size]

        record = Record(head, block)
        yield record
        if end[0] is None:
            finish()
        at = end[0]


def member_length(start: bytes) -> int:
    """Bytes of a gzip member, from its ``sl`` extra field, or 0."""
    if len(start) < 20 or start[:4] != b"\x1f\x8b\x08\x04" or start[12:16] != b"sl\x04\x00":
        return 0
    return struct.unpack("<I", start[16:20])[0]


def member(data: bytes, level: int = 3) -> bytes:
    """A gzip member that tells its own length."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    total = 20 + len(body) + 8
    length = struct.pack("<I", total if total < 2**32 else 0)
    return b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H", 8) + b"sl\x04\x00" + length + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record_bytes(row: dict[str, Any]) -> bytes:
    """A response or revisit record."""
    payload = row["payload"] or b""
    block = HTTP + (b"" if row["record_type"] == "revisit" else payload)
    digest = row["payload_digest"]
    headers = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row["page_id"]}:{digest}')}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", row["url"]),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Page-Id", row["page_id"]),
        ("X-Payload-Length", row["payload_bytes"]),
    ]
    if row["record_type"] == "revisit":
        headers += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row["refers_to"]}:{digest}')}>"),
            ("X-Refers-To-Page-Id", row["refers_to"]),
        ]
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    lines = [f"{k}: {re.sub('[\r\n]', lambda m: f'%{ord(m[0]):02X}', str(v))}" for k, v in headers if v is not None]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.plain = options.get("compression", "gzip") == "none"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        names: list[str] = []
        out, room = None, 0
        for batch in iterator:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    data = record_bytes(row) if self.plain else member(record_bytes(row))
                    if out is None or room < len(data):
                        if out is not None:
                            out.close()
                        names.append(f"part-{uuid.uuid4().hex}.warc" + ("" if self.plain else ".gz"))
                        out, room = fs.open_output_stream(f"{root}/.{names[-1]}", compression=None), FILE_BYTES
                    out.write(data)
                    room -= len(data)
        if out is not None:
            out.close()
        return Files(names)

    def commit(self, messages) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        for message in messages:
            for name in message.names if message else ():
                fs.move(f"{root}/.{name}", f"{root}/{name}")

    def abort(self, messages) -> None:
        fs, root = file_system(self.path)
        for message in messages:
            for name in message.names if message else ():
                fs.delete_file(f"{root}/.{name}")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def archive(pages: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write pages (page_id, url, html): a response for each payload's first page, revisits for the others.

    Digests alone find the copies. Only the keys of repeated payloads meet the pages again.
    """
    register(pages.sparkSession)
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": F.sha2("payload", 256)})
    narrow = rows.where(F.col("payload_bytes") >= LEAST_REVISIT)
    copies = narrow.groupBy("payload_digest").agg(F.count("*").alias("n"), F.min("page_id").alias("refers_to")).where("n > 1").drop("n")
    found = rows.join(copies, "payload_digest", "left")
    again = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    found = found.withColumns(
        {
            "record_type": F.when(again, "revisit").otherwise("response"),
            "refers_to": F.when(again, F.col("refers_to")),
            "payload": F.when(~again, F.col("payload")),
        }
    )
    columns = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    found.select(*columns).write.format("warc").mode("append").option("compression", compression).save(path)


def records(spark: SparkSession, path: str, schema: str = SCHEMA, **options: str) -> DataFrame:
    """Records of an archive folder; leave ``payload`` out of the schema to skip decoding it."""
    register(spark)
    return spark.read.format("warc").schema(schema).options(**options).load(path)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "warc")
    archive(table(spark, sf_dir, "pages"), path)
    full = records(spark, path, "page_id bigint, record_type string, payload binary").where("record_type = 'response'")
    full = full.select(
        "page_id",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("bigint").alias("refers_to"),
    )
    short = records(spark, path, "page_id bigint, record_type string, payload_bytes bigint, payload_digest string, headers map<string,string>")
    short = short.where("record_type = 'revisit'").select(
        "page_id",
        "payload_bytes",
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
        "record_type",
        F.element_at("headers", "X-Refers-To-Page-Id").cast("bigint").alias("refers_to"),
    )
    return full.union(short)


OP6_SQL = f"""
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, octet_length(encode(html))::bigint as payload_bytes, sha256(html) as payload_digest from p),
m as (select *, min(page_id) over (partition by payload_digest) as first from d)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= {LEAST_REVISIT} and page_id <> first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= {LEAST_REVISIT} and page_id <> first then first end as refers_to
from m
"""
