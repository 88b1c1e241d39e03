"""Operators on small fixtures, with nulls, ties and late rows; queries with SQL against DuckDB on the smallest tables."""

import os
import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quernstone.operators.groups import sessions, top_k
from quernstone.operators.joins import asof_join, band_join, interval_join, overlap_join
from quernstone.operators.vectors import nearest
from quernstone.plans import registry
from quernstone.sinks.files import FORMATS, round_trip
from quernstone.sources.tables import TABLES, table, views
from quernstone.streaming import windows

DATA = "/root/testdata/sf0.001"


def rows_of(frame: pd.DataFrame) -> list[str]:
    def value(v):
        if hasattr(v, "tolist") and not hasattr(v, "year"):
            v = v.tolist()
        if isinstance(v, list):
            return v
        return None if pd.isna(v) else pd.Timestamp(v) if hasattr(v, "year") else v

    plain = frame[sorted(frame.columns)].astype(object)
    return sorted(repr(tuple(map(value, row))) for row in plain.itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_queries_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    assert rows_of(registry.QUERIES[name](spark, DATA).toPandas()) == rows_of(con.execute(registry.ORACLE_SQL[name]).df())


def test_asof_takes_the_latest_that_is_not_later(spark):
    left = spark.createDataFrame([(1, 10, "a"), (1, 4, "b"), (2, 10, "c"), (None, 10, "d")], "k long, t long, x string")
    right = spark.createDataFrame([(1, 5, 50), (1, 10, 100), (1, 10, 101), (1, 11, 110), (3, 1, 1)], "k long, t long, v long")
    got = {r.x: r.v for r in asof_join(left, right, "k", "t", "t", ["v"]).collect()}
    assert got == {"a": 101, "b": None, "c": None, "d": None}


@pytest.mark.parametrize("step", [1.0, 7.0, 1e6])
def test_asof_against_a_plain_search(spark, step):
    draw = random.Random(3)
    left = [(draw.choice([1, 1, 1, 2, None]), draw.choice([draw.randrange(60), None]), i) for i in range(200)]
    right = [(draw.choice([1, 1, 2, None]), draw.choice([draw.randrange(60), None]), i) for i in range(60)]
    got = {r.x: r.v for r in asof_join(spark.createDataFrame(left, "k long, t long, x long"), spark.createDataFrame(right, "k long, t long, v long"), "k", "t", "t", ["v"], step).collect()}
    for k, t, x in left:
        held = [(u, v) for q, u, v in right if None not in (k, t, q, u) and q == k and u <= t]
        assert got[x] == (max(held)[1] if held else None)
    assert len(got) == len(left)


def test_nearest_against_all_pairs(spark):
    """Vectors of two lengths, null and empty ones, and a query that is there twice, in blocks of any size."""
    draw = random.Random(4)
    vector = lambda n: [float(draw.randrange(-3, 4)) for _ in range(n)]
    rows = [(i, vector(5)) for i in range(60)] + [(-i, vector(2)) for i in range(1, 9)] + [(100, None), (101, [1.0]), (None, [0.0] * 5), (102, [9.0] * 5), (103, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    good = [(i, v) for i, v in rows if i is not None and v]
    asked = [(i, v) for i, v in good if i < 10] + [good[0]]
    queries = spark.createDataFrame(asked, frame.schema)
    want = []
    for i, v in asked:
        best = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in good if j != i and len(v) == len(w))[:4]
        want += [(i, j, -x, n + 1) for n, (x, j) in enumerate(best)]
    for block in (2, 100):
        assert sorted(tuple(r) for r in nearest(frame, queries, 4, block=block).collect()) == sorted(want)
    assert nearest(frame, frame.limit(0), 3).collect() == []


TEXTS = ['a "quoted", text\nline', None, "", " blank ", "  ", "\\N", "\\", "\\\\N", "a\r\nb", "\r", "\n", "_", "__HIVE_DEFAULT_PARTITION__", "a/b=c", "x\ty", "#c", '"', '""', ",", "null", "NaN", "é𝕏", "\x01", "a\\", '\\"']


@pytest.mark.parametrize("by", [None, ["p"], ["p", "b"]])
@pytest.mark.parametrize("kind", FORMATS)
def test_written_rows_come_back(spark, kind, by):
    """The same rows for every format: texts with line breaks, blanks, marks and nothing, also as names of partitions."""
    at = datetime(2024, 1, 1, 1, 2, 3, 123456)
    rows = [(i, t, t, [1.5, -0.0, float("inf"), None][i % 4], at if i % 3 else None, i % 2 == 0) for i, t in enumerate(TEXTS)]
    frame = spark.createDataFrame(rows, "i long, t string, p string, x double, m timestamp_ntz, b boolean").withColumn("z", F.col("m").cast("timestamp"))
    got = round_trip(frame, kind, by)
    assert got.schema == frame.schema and sorted(map(repr, got.collect())) == sorted(map(repr, frame.collect()))
    with pytest.raises(ValueError):
        round_trip(frame, "none")


def test_filters_on_partitions_leave_out_folders(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i long, p string")
    found = round_trip(frame, "parquet", ["p"]).where("p = ''")
    assert [r.i for r in found.collect()] == [2]
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_interval_join_at_the_borders(spark):
    left = spark.createDataFrame([(1, 0.0), (1, 3599.0), (1, 3600.0), (1, 7201.0), (2, 3600.0)], "k long, at double")
    right = spark.createDataFrame([(1, 3600.0, 7200.0)], "q long, low double, high double")
    got = interval_join(left, right, [("k", "q")], F.col("at"), F.col("low"), F.col("high"), 1000).select("at").collect()
    assert [r.at for r in got] == [3600.0]


def spans(draw, n):
    """key, low, high, number: with ties, nulls, empty, very long and endless ones."""
    out = []
    for i in range(n):
        low = draw.choice([float(draw.randrange(100)), 50.0, 50.0, None, draw.uniform(0, 100)])
        high = None if low is None else low + draw.choice([0, 1, 5, draw.uniform(0, 20), -1, 1e9 if draw.random() < 0.1 else 3, float("inf") if draw.random() < 0.05 else 2])
        out.append((draw.choice([1, 1, 1, 2, None]), low, high, i))
    return out


@pytest.mark.parametrize("step", [1, 1000, 0.1])
def test_interval_join_against_all_pairs(spark, step):
    draw = random.Random(8)
    held = spans(draw, 120)
    points = [(draw.choice([1, 1, 2, None]), draw.choice([None, draw.uniform(-50, 150), 50.0, float("inf"), 1e9, float("nan")]), i) for i in range(100)]
    left, right = spark.createDataFrame(points, "k long, t double, i long"), spark.createDataFrame(held, "q int, low double, high double, j long")
    got = sorted((r.i, r.j) for r in interval_join(left, right, [("k", "q")], F.col("t"), F.col("low"), F.col("high"), step).collect())
    assert got == sorted((i, j) for k, t, i in points for q, low, high, j in held if None not in (k, t, low, high) and k == q and low <= t <= high) != []


def test_a_very_long_interval_has_few_buckets(spark):
    right = spark.createDataFrame([(0.0, 1e9)], "low double, high double")
    joined = interval_join(spark.createDataFrame([(5.0,)], "t double"), right, [], F.col("t"), F.col("low"), F.col("high"), 1)
    assert [tuple(r) for r in joined.collect()] == [(5.0, 0.0, 1e9)]


def test_a_full_bucket_of_few_rows_meets_in_many_tasks(spark):
    rows = spark.range(10_000).select(F.col("id"), (F.col("id") / 20_000).alias("t"))
    near = rows.select(F.col("id").alias("j"), (F.col("t") - 0.00005).alias("low"), (F.col("t") + 0.00005).alias("high"))
    found = interval_join(rows, near, [], F.col("t"), F.col("low"), F.col("high"), 1).select("id", "j", F.spark_partition_id().alias("task")).collect()
    inside = lambda i, j: j / 20_000 - 0.00005 <= i / 20_000 <= j / 20_000 + 0.00005
    assert sorted((r.id, r.j) for r in found) == [(i, j) for i in range(10_000) for j in range(max(0, i - 2), min(10_000, i + 3)) if inside(i, j)]
    assert len({r.task for r in found}) > 1


def test_near_prices_shuffles_and_stores_few_bytes(spark, tmp_path, monkeypatch):
    """Of many equal prices, the result is large; what is shuffled and written is about the input."""
    from quernstone.operators import joins

    stored = []
    monkeypatch.setattr(joins, "settled", lambda f, name, settled=joins.settled: stored.append(settled(f, name)) or stored[-1])
    spark.range(4_000).select(F.col("id").alias("p_partkey"), (900 + F.col("id") % 20 / 10).alias("p_retailprice")).write.parquet(str(tmp_path / "part.parquet"))
    found = registry.QUERIES["near_prices"](spark, str(tmp_path))
    prices = [900 + i % 20 / 10 for i in range(4_000)]
    alike = {(a, b): prices[a] - 0.25 <= prices[b] <= prices[a] + 0.25 for a in range(20) for b in range(20)}
    want = {(i, j) for i in range(4_000) for j in range(i + 1, 4_000) if alike[i % 20, j % 20]}
    got = [tuple(r) for r in found.select("part", "near_part").toPandas().itertuples(index=False)]
    assert len(got) == len(want) and set(got) == want
    assert sum(f.count() for f in stored) <= 8_000


@pytest.mark.parametrize("tile", [1 << 15, 8, 3])
@pytest.mark.parametrize("order", [None, ("i", "j")])
def test_band_join_against_all_pairs(spark, order, tile):
    """Nulls, ties, endless and empty bands; NaN is the largest number and its own equal, as in SQL."""
    draw = random.Random(10)
    held = [(low, high, j) for _, low, high, j in spans(draw, 120)] + [(float("nan"), float("nan"), 120), (90.0, float("nan"), 121), (float("inf"), float("inf"), None)]
    points = [(draw.choice([None, draw.uniform(-50, 150), 50.0, 50.0, float("inf"), float("nan")]), i) for i in range(150)]
    left, right = spark.createDataFrame(points, "t double, i long"), spark.createDataFrame(held, "low double, high double, j long")
    got = band_join(left, right, F.col("t"), F.col("low"), F.col("high"), order, tile).select("i", "j").collect()
    at = lambda x: (x != x, 0 if x != x else x)
    want = [(i, j) for t, i in points for low, high, j in held if None not in (t, low, high) and at(low) <= at(t) <= at(high) and (order is None or (j is not None and j < i))]
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want)) != []
    assert band_join(left.limit(0), right, F.col("t"), F.col("low"), F.col("high"), order, tile).collect() == []


@pytest.mark.parametrize(("tile", "parts"), [(1 << 15, 4), (8, 5), (3, 1)])
@pytest.mark.parametrize("by", [[], [("k", "q")]])
def test_overlap_join_against_all_pairs(spark, by, tile, parts):
    draw = random.Random(9)
    a, b = spans(draw, 120), spans(draw, 150)
    left, right = spark.createDataFrame(a, "k long, a double, b double, i long"), spark.createDataFrame(b, "q int, c double, d double, j long")
    got = sorted((r.i, r.j) for r in overlap_join(left, right, by, ("a", "b"), ("c", "d"), parts, tile).collect())
    alike = lambda k, q: not by or (k is not None and k == q)
    assert got == sorted((i, j) for k, s, e, i in a for q, c, d, j in b if None not in (s, e, c, d) and s <= e and c <= d and s <= d and c <= e and alike(k, q)) != []
    assert overlap_join(left.limit(0), right, by, ("a", "b"), ("c", "d")).collect() == []


def test_top_k_and_sessions(spark):
    frame = spark.createDataFrame([("a", i % 4, i) for i in range(12)] + [(None, 1, 99)], "g string, v long, i long")
    got = top_k(frame, ["g"], [F.desc("v"), F.asc("i")], 2).collect()
    assert sorted((str(r.g), r.i, r["rank"]) for r in got) == [("None", 99, 1), ("a", 3, 1), ("a", 7, 2)]
    start = datetime(2024, 1, 1)
    events = spark.createDataFrame([(1, start + timedelta(minutes=m)) for m in (0, 10, 45, 46, 200)], "u long, t timestamp")
    assert sorted(r.n_events for r in sessions(events, "u", "t", "30 minutes").collect()) == [1, 2, 2]


def test_late_rows_are_left_out_of_a_stream(spark, tmp_path):
    schema = "ts timestamp_ntz, event_type string, value double"
    hour = datetime(2024, 1, 1)
    for i, hours in enumerate(([0, 1, 5], [0], [9])):
        spark.createDataFrame([(hour + timedelta(hours=h), "a", 1.0) for h in hours], schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"f{i}"))
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        query = windows.hourly(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).option("path", str(tmp_path / "out")).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    got = {r.hour.hour: r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {0: 1, 1: 1, 5: 1}


def test_tables(spark):
    with pytest.raises(ValueError):
        table(spark, DATA, "nothing")
    if os.path.isdir(DATA):
        views(spark, DATA, "region")
        assert spark.sql("SELECT count(*) AS n FROM region").first().n == 5
