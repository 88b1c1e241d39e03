"""The Merkle audit against a plain comparison, and the DuckDB SQL of the query."""

import hashlib
import uuid

import pytest

from pyspark.sql import functions as F

from quernstone.llm import warc


def record_of(number, url, html):
    html, url = html or "", url or "about:blank"
    name = hashlib.md5(f"{'' if number is None else number} {url} {html}".encode()).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html.encode())}\r\n\r\n{html}".encode()
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:{uuid.UUID(name)}>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: {url}\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: {len(http)}\r\n\r\n"
    return head.encode() + http + b"\r\n\r\n"


def plain(rows):
    made = {}
    for number, url, html in rows:
        made.setdefault(None if number is None else number // 256, []).append((number or 0, record_of(number, url, html)))
    out = []
    for segment, records in made.items():
        offset = 0
        for place, (number, record) in enumerate(sorted(records, key=lambda r: (r[0], hashlib.sha256(r[1]).hexdigest()))):
            out.append((number, segment, place, offset, len(record), hashlib.sha256(record).hexdigest()))
            offset += len(record)
    return out


ROWS = [(i * 3, f"http://x/{i}", f"<p>é {i}</p>" * (i % 7)) for i in range(300)] + [(9, "http://x/again", None), (9, "http://x/again", None), (7000, None, "x" * 100_000)]


def test_report(spark):
    frame = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3).selectExpr("*", "1 as id", "2 as segment")
    manifest = warc.records(frame)
    want = plain(ROWS)
    lost, bad = {0, 300, 7000}, {3, 6, 444}
    replica = warc.damaged(manifest, F.col("id").isin(*bad), F.col("id").isin(*lost))
    got = warc.report(manifest, replica).collect()
    assert sorted((r.page_id, r.segment, r.place, r.offset, r.length, r.digest) for r in got) == sorted(want)
    assert {r.page_id for r in got if r.status == "missing"} == lost and {r.page_id for r in got if r.status == "corrupt"} == bad
    assert all((r.found == r.digest) == (r.status == "ok") for r in got)
    assert warc.audit(warc.leaves(manifest), warc.leaves(manifest)).collect() == []
    # a replica that lacks whole rows
    assert {(r.segment, r.place) for r in warc.audit(warc.leaves(manifest), warc.leaves(manifest).where("id <> 300")).collect()} == {(s, p) for i, s, p, *_ in want if i == 300}


def test_large_segments_and_edges(spark):
    same = spark.createDataFrame([(5, "u", str(i)) for i in range(5000)], "page_id long, url string, html string")
    manifest = warc.records(same)
    got = warc.report(manifest, warc.damaged(manifest, F.col("digest") == F.sha2(F.col("record"), 256), F.lit(False)))
    assert got.where("status <> 'corrupt'").count() == 0 and got.count() == 5000
    one = manifest.orderBy("digest").first().digest
    got = warc.report(manifest, warc.damaged(manifest, F.col("digest") == one, F.lit(False)))
    assert [(r.place, r.digest, r.status) for r in got.where("status <> 'ok'").collect()] == [(0, one, "corrupt")]
    assert warc.report(warc.records(same.limit(0)), warc.records(same.limit(0))).collect() == []
    missing = warc.records(spark.createDataFrame([(None, "u", "a"), (None, None, None)], "page_id long, url string, html string"))
    assert {r.segment < 0 for r in missing.collect()} == {True}


def test_records_are_read_back(spark):
    rows = [(1, "http://x/é", "<p>é</p>\r\n\r\nWARC/1.0"), (2, None, None), (None, " a b\n", "x" * 100_000), (3, "u", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as record", "'x' as URL")
    made = warc.records(frame)
    got = sorted((r.url, r.html) for r in warc.read(made).collect())
    assert got == sorted([("http://x/é", rows[0][2]), ("about:blank", ""), ("a%20b", rows[2][2]), ("u", "")])
    assert {r.date for r in warc.read(made).collect()} == {warc.DATE} and all(uuid.UUID(r.record_id[10:-1]) for r in warc.read(made).collect())
    whole = b"".join(r.record for r in made.collect())
    assert len(list(warc.parse(whole))) == 4 and list(warc.parse(b"")) == []
    for broken in (whole[:-1], b"x" + whole, whole[:40]):
        with pytest.raises(ValueError):
            list(warc.parse(broken))
    assert warc.read(warc.damaged(made, F.lit(False), F.lit(True))).collect() == []


def test_a_repeated_record(spark):
    rows = [(5, "u", "same")] * 9000 + [(5, "u", "other"), (6, "u", "next")]
    manifest = warc.records(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = warc.report(manifest, warc.damaged(manifest, F.col("id") == 6, F.lit(False)))
    assert sorted((r.page_id, r.segment, r.place, r.offset, r.length, r.digest) for r in got.collect()) == sorted(plain(rows))
    assert [(r.page_id, r.place, r.status) for r in got.where("status <> 'ok'").collect()] == [(6, 9001, "corrupt")]
