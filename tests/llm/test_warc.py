"""WARC: round trips, predicates, skipped payloads, foreign archives, odd rows."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from crawlspark.llm import warc as W

LONG = "<p>" + "x" * 200
PAGES = [
    (1, "http://a/1", LONG),
    (2, "http://a/2", LONG),
    (3, None, LONG + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "ü" * 90000),
    (4, "http://a/\r\nX: y", "short"),
    (5, "http://a/5", "short"),
    (6, "http://b/6", None),
    (7, "http://b/7", ""),
    (None, "http://b/n", LONG),
    (1, "http://a/1", LONG),
    (None, "http://b/m", "only null ids " * 20),
]


def pages(spark):
    return spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, record_type string")


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip(spark, tmp_path, compression):
    path = f"file://{tmp_path}/out"
    W.archive(pages(spark).repartition(3), path, compression)
    rows = W.records(spark, path).collect()
    assert len(rows) == len(PAGES)
    for page_id, url, html in PAGES:
        body = (html or "").encode()
        mine = [r for r in rows if r["page_id"] == page_id and r["target_uri"] == (url and url.replace("\r", "%0D").replace("\n", "%0A"))]
        again = html == LONG and page_id != 1
        for r in mine:
            assert r["record_type"] == ("revisit" if again else "response")
            assert r["payload_digest"] == "sha256:" + hashlib.sha256(body).hexdigest() and r["payload_bytes"] == len(body)
            assert r["payload"] == (b"" if again else body)
            assert r["headers"].get("X-Refers-To-Page-Id") == ("1" if again else None)
        first = next(r for r in rows if r["page_id"] == 1)
        assert not again or all(r["refers_to"] == first["record_id"] for r in mine)
        assert len(mine) == (2 if page_id == 1 else 1)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_predicates(spark, tmp_path, compression):
    path = f"file://{tmp_path}/out"
    W.archive(pages(spark), path, compression)
    read = W.records(spark, path)
    assert {r["page_id"] for r in read.where("record_type = 'revisit'").collect()} == {2, None}
    assert {r["page_id"] for r in read.where("target_uri like 'http://b/%' and page_id in (6, 7, 1)").collect()} == {6, 7}
    assert {r["page_id"] for r in read.where("target_uri is null").collect()} == {3}
    assert read.where("page_id is not null and content_length > 1000").count() == 1
    plan = read.where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "- Filter" not in plan
    assert {r["page_id"] for r in W.records(spark, path, **{"header.x-page-id": "5"}).collect()} == {5}


def test_unwanted_payloads_are_not_decoded(tmp_path):
    body = random.Random(1).randbytes(1_000_000)
    row = {"page_id": 1, "url": "u", "record_type": "response", "refers_to": None, "payload": body, "payload_digest": "d", "payload_bytes": len(body)}
    good = W.member(W.record_bytes(row))
    broken = good[:-9000] + b"\xff" * 9000  # can't be inflated to its end, but tells its length
    (tmp_path / "a.warc.gz").write_bytes(broken + good)
    with W.file_system(str(tmp_path / "a.warc.gz"))[0].open_input_file(str(tmp_path / "a.warc.gz")) as file:
        found = list(W.members(file))
        assert len(found) == 2 and W.entity(found[1].block(), {"content-type": "application/http"}) == body
        with pytest.raises(Exception):
            found[0].block()


def test_foreign_archive(spark, tmp_path):
    def record(kind, block, extra=""):
        return f"WARC/1.0\r\nwarc-type: {kind}\r\nWARC-Record-ID: <urn:x>\r\n{extra}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    parts = [record("warcinfo", b"software: x"), record("response", b"HTTP/1.1 200\r\na: b\r\n\r\nbody", "Content-Type: application/http\r\n"), record("resource", b"\r\n" * 4000, "X-Long: a\r\n  b\r\n")]
    (tmp_path / "one.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    (tmp_path / "two.warc").write_bytes(b"".join(parts))
    (tmp_path / "note.txt").write_text("no archive")
    rows = W.records(spark, str(tmp_path)).collect()
    assert sorted((r["record_type"], bytes(r["payload"])) for r in rows) == sorted(2 * [("warcinfo", b"software: x"), ("response", b"body"), ("resource", b"\r\n" * 4000)])
    assert {r["headers"].get("X-Long") for r in rows} == {None, "a b"}
    assert W.records(spark, str(tmp_path), "record_id string, record_type string").where("record_type = 'resource'").count() == 2


def test_empty(spark, tmp_path):
    path = f"file://{tmp_path}/none"
    W.archive(pages(spark).limit(0), path)
    assert W.records(spark, path).count() == 0
    assert W.records(spark, path).where(F.col("record_type") == "revisit").count() == 0
