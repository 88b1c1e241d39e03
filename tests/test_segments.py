"""The data source of JSON line segments: round trips, ranges, pushed filters, commits and aborts."""

import datetime
import io
import math
import os
import random
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from quernstone.sinks.files import shared_path
from quernstone.sources import segments

ROWS = [
    (1, "plain", 1.5, True, datetime.date(1996, 2, 29), datetime.datetime(1996, 2, 29, 1, 2, 3, 456789)),
    (2, "", math.inf, None, datetime.date(1, 1, 1), datetime.datetime(1, 1, 1)),
    (3, " two\nlines\r\n  \u0000 õ\U0001f600 \"q\" ", -math.inf, False, None, None),
    (None, None, None, None, None, None),
    (-(2**63), "x" * 5000, -0.0, True, datetime.date(9999, 12, 31), datetime.datetime(9999, 12, 31, 23, 59, 59, 999999)),
    (1, "plain", 1.5, True, datetime.date(1996, 2, 29), datetime.datetime(1996, 2, 29, 1, 2, 3, 456789)),
]
KINDS = "i long, t string, x double, b boolean, d date, at timestamp_ntz"


def sorted_rows(rows):
    return sorted(map(tuple, rows), key=repr)


def files(path):
    root = urlparse(path).path
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names)


@pytest.mark.parametrize("range_bytes", [50, 77, 100, 1 << 20])
def test_rows_come_back(spark, range_bytes):
    path = shared_path(spark, "segments")
    frame = spark.createDataFrame(ROWS, KINDS).repartition(2)
    segments.write(frame, path, segment_bytes=200)
    found = segments.read(spark, path, range_bytes)
    assert found.schema == frame.schema and sorted_rows(found.collect()) == sorted_rows(ROWS)


def test_moments_and_nan_come_back(spark):
    path = shared_path(spark, "segments")
    frame = spark.sql("SELECT timestamp'2001-02-03 04:05:06.789' AS at, double('NaN') AS x, float('0.1') AS f, tinyint(-3) AS b")
    segments.write(frame, path)
    found = segments.read(spark, path)
    assert found.dtypes == frame.dtypes and all(f.nullable for f in found.schema)
    assert repr(found.collect()) == repr(frame.collect())
    assert found.where("x > 5 AND at = timestamp'2001-02-03 04:05:06.789'").count() == 1  # NaN is the greatest


def test_each_line_is_in_one_range(monkeypatch):
    draw = random.Random(5)
    for step in (1, 3, 16):
        monkeypatch.setattr(segments, "STEP", step)
        for _ in range(60):
            lines = [b"x" * draw.randrange(6) for _ in range(draw.randrange(8))]
            body, size = b"".join(x + b"\n" for x in lines), draw.randrange(1, 9)
            got = [x for i in range(0, len(body), size) for x in segments.lines_of(io.BytesIO(body), i, min(i + size, len(body)))]
            assert got == lines


def test_filters_reach_the_source(spark, capsys):
    path = shared_path(spark, "segments")
    frame = spark.range(0, 1000, 1, 10).select("id", F.when(F.col("id") >= 100, F.concat(F.lit("k"), "id")).alias("k"), F.date_add(F.lit("2000-01-01"), F.col("id").cast("int")).alias("d"))
    segments.write(frame, path)
    found = segments.read(spark, path)
    for condition, ranges in (("id >= 250 AND id < 320", 2), ("id = 5", 1), ("id IN (5, 905)", 2), ("k IS NULL", 1), ("k = 'k150'", 1), ("d < '2000-02-01'", 1), ("id > 5000", 0), ("NOT id = 5", 10), ("id % 2 = 0", 10)):
        some = found.where(condition)
        assert sorted_rows(some.collect()) == sorted_rows(frame.where(condition).collect()), condition
        assert some.rdd.getNumPartitions() == max(ranges, 1), condition
    found.where("id > 5 AND k = 'a'").explain("formatted")
    for condition in ("id <=> 7", "id IN (1, null)", "k > 'k8' OR id = 3", "k LIKE 'k1%'", "k >= 'k99' AND d IS NOT NULL", "d = '2000-01-02'", "NOT k = 'k150'", "id <= 3 AND k IS NULL"):
        assert sorted_rows(found.where(condition).collect()) == sorted_rows(frame.where(condition).collect()), condition
    plan = capsys.readouterr().out
    assert "PushedFilters: [" in plan and "GreaterThan" in plan and "EqualTo" in plan, plan


def test_an_aborted_write_leaves_nothing(spark):
    path = shared_path(spark, "segments")
    segments.write(spark.range(5), path)
    before = files(path)
    broken = spark.range(0, 4000, 1, 4).select(F.when(F.col("id") == 3999, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception):
        segments.write(broken, path, segment_bytes=100)
    assert files(path) == before and segments.read(spark, path).count() == 5


def test_append_overwrite_and_no_rows(spark):
    path = shared_path(spark, "segments")
    with pytest.raises(Exception, match="nothing was committed"):
        segments.read(spark, path).count()
    segments.write(spark.range(5), path)
    segments.write(spark.range(5, 8), path)
    assert sorted(r.id for r in segments.read(spark, path).collect()) == list(range(8))
    with pytest.raises(Exception, match="other columns"):
        segments.write(spark.range(3).selectExpr("id", "1 AS more"), path)
    segments.write(spark.sql("SELECT CAST(null AS long) AS id"), path)
    assert segments.read(spark, path).where("id IS NULL").count() == 1
    segments.write(spark.range(3), path, overwrite=True)
    assert sorted(r.id for r in segments.read(spark, path).collect()) == [0, 1, 2]
    segments.write(spark.range(0).selectExpr("id", "'a' AS a"), path, overwrite=True)
    found = segments.read(spark, path)
    assert found.columns == ["id", "a"] and found.collect() == []


def test_what_attempts_left_is_never_read(spark):
    path = shared_path(spark, "segments")
    segments.write(spark.range(5), path)
    root = urlparse(path).path
    os.makedirs(f"{root}/data-lost")
    for name in ("data-lost/a.ndjson", "new-1"):
        with open(f"{root}/{name}", "w") as f:
            f.write('{"id":99}\n')
    assert segments.read(spark, path).count() == 5


def test_other_types_are_refused(spark):
    for frame in (spark.sql("SELECT array(1) AS a"), spark.sql("SELECT 1.5BD AS a")):
        with pytest.raises(Exception, match="no segments of"):
            segments.write(frame, shared_path(spark, "segments"))


def test_streams_read_and_write_each_commit_once(spark):
    source, sink, checkpoint = (shared_path(spark, "segments") for _ in range(3))

    def drain():
        segments.drain(source, sink, "evens", spark, checkpoint, lambda frame: frame.where("id % 2 = 0"), range_bytes=64)

    for low in (0, 100, 200):
        segments.write(spark.range(low, low + 50, 1, 3), source, segment_bytes=100)
        segments.write(spark.range(low + 50, low + 60), source)
        drain()
        drain()  # nothing new
    want = [i for low in (0, 100, 200) for i in range(low, low + 60) if i % 2 == 0]
    assert sorted(r.id for r in segments.read(spark, sink).collect()) == want
    # a batch that comes again is not added, and leaves no file
    written = [h for _, h in segments.heads(sink)]
    assert [h["batch"] for h in written] == sorted({h["batch"] for h in written}) and len(written) >= 3
    before = files(sink)
    writer = segments.StreamWriter(segments.Writer(sink, segments.committed(sink)[0], False, 1 << 20), "evens")
    import pyarrow as pa

    message = writer.write(iter([pa.RecordBatch.from_pydict({"id": [998]})]))
    assert len(files(sink)) == len(before) + 1
    writer.commit([message, None], 0)
    assert files(sink) == before and segments.read(spark, sink).count() == len(want)
    # rows that a stream has read can't be hidden from it
    segments.write(spark.range(1), source, overwrite=True)
    with pytest.raises(Exception, match="hides rows"):
        drain()
