"""Stored sketches, bucketed and partitioned tables, and the vector index: results and plans."""

import random

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quernstone.operators import sketches
from quernstone.operators.vector_index import build
from quernstone.operators.vectors import nearest
from quernstone.plans import registry
from quernstone.sinks.files import shared_path
from quernstone.sinks.tables import bucketed, overwrite_partitions


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_sketches_merge_to_what_the_rows_say(spark):
    rows = spark.range(200_000).select((F.col("id") % 20).alias("day"), F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("g"), (F.col("id") * 7919 % 90_001).alias("x"), F.sqrt("id").alias("y"))
    path = sketches.store(rows, F.col("day"), ["g"], ["x"], ["y"])
    error, low, high = sketches.errors(), 3, 9
    found = sketches.merged(spark, path, low, high, ["g"])
    assert "PartitionFilters: [isnotnull(period" in plan(found) and "Range" not in plan(found)  # folders are chosen, base rows not read
    got = {r.g: r for r in sketches.estimated(found, [0.1, 0.5, 0.9]).collect()}
    kept = rows.where(F.col("day").between(low, high)).toPandas()
    for g, own in kept.groupby("g"):
        distinct, values = own.x.nunique(), np.sort(own.y)
        assert got[g].rows == len(own)
        assert abs(got[g].theta_x - distinct) <= 4 * error["theta"] * distinct and abs(got[g].hll_x - distinct) <= 4 * error["hll"] * distinct
        for q, estimate in zip([0.1, 0.5, 0.9], got[g].kll_y):
            assert abs(np.searchsorted(values, estimate) / len(values) - q) <= 1.5 * error["kll"]


def test_storing_a_day_again_replaces_it_alone(spark):
    rows = spark.createDataFrame([(1, 5), (1, 6), (2, 7), (2, None), (None, 8)], "day int, x long")
    path = sketches.store(rows, F.col("day"), distinct=["x"])
    sketches.store(spark.createDataFrame([(2, 9), (2, 5), (2, 5)], rows.schema), F.col("day"), distinct=["x"], path=path)
    got = sketches.estimated(sketches.merged(spark, path, 1, 2)).first()
    assert (got.rows, got.theta_x, got.hll_x) == (5, 3, 3)  # 5, 6 and 9: few values are exact
    assert sketches.estimated(sketches.merged(spark, path, 2, 2)).first().theta_x == 2


def test_bucketed_tables_join_and_group_without_a_shuffle(spark):
    a = bucketed(spark.range(1000).select("id", (F.col("id") % 7).alias("x")), ["id"], 8)
    b = bucketed(spark.range(3000).select((F.col("id") % 1000).alias("key"), F.col("id").alias("y")), ["key"], 8)
    joined = a.hint("merge").join(b, F.col("id") == F.col("key")).groupBy("id").agg(F.sum("y").alias("y"), F.max("x").alias("x"))
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    assert {(r.id, r.y, r.x) for r in joined.collect()} == {(i, 3 * i + 3000, i % 7) for i in range(1000)}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_overwritten_partitions(spark):
    path = shared_path(spark, "parts")
    frame = spark.createDataFrame([(i, i % 3) for i in range(9)], "i long, p int")
    overwrite_partitions(frame, path, ["p"])
    overwrite_partitions(spark.createDataFrame([(100, 1)], frame.schema), path, ["p"])
    found = spark.read.schema(frame.schema).parquet(path)
    assert sorted(map(tuple, found.collect())) == [(0, 0), (2, 2), (3, 0), (5, 2), (6, 0), (8, 2), (100, 1)]
    assert "PartitionFilters: [isnotnull(p" in plan(found.where("p = 1"))


@pytest.fixture(scope="module")
def vectors(spark):
    draw = random.Random(3)
    centres = [[draw.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    rows = [(i, [x + draw.gauss(0, 0.3) for x in draw.choice(centres)]) for i in range(600)] + [(900, None), (901, [1.0]), (None, [0.0] * 8), (902, [])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_the_index_holds_every_row_and_is_exact_with_all_cells(spark, vectors):
    index = build(vectors, cells=9)
    assert sorted(r.id for r in index.rows.collect()) == list(range(600)) and len(index.centres) == 9
    queries = vectors.where("vec_id % 20 = 0").unionAll(vectors.where("vec_id = 40"))
    exact = sorted(map(tuple, nearest(vectors, queries, 10).collect()))
    assert sorted(map(tuple, index.nearest(queries, 10, 9).where("query_id < 900").collect())) == [r for r in exact if r[0] < 900]
    found = {(r.query_id, r.id) for r in index.nearest(queries, 10, 4).collect()}
    wanted = {r[:2] for r in exact if r[0] < 600}
    assert len(found & wanted) >= 0.9 * len(wanted)


def test_a_fit_sends_the_driver_centres_but_not_their_distances(spark):
    """A stage with a task for each centre collects the distances to all others: the square of the cells."""
    draw = np.random.default_rng(5)
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(draw.normal(size=(1200, 8)).tolist())], "vec_id long, embedding array<double>")
    spark.sparkContext.setJobGroup("fit", "index")
    try:
        centres = build(rows, cells=400).centres
        tracker = spark.sparkContext.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("fit") for s in tracker.getJobInfo(j).stageIds}
        tasks = [found.numTasks for s in stages if (found := tracker.getStageInfo(s))]
    finally:
        for key in ("spark.jobGroup.id", "spark.job.description"):
            spark.sparkContext.setLocalProperty(key, None)
    assert len(centres) == 400 and tasks and max(tasks) < 100
    plain = KMeans(k=400, seed=7, maxIter=20, solver="row").fit(rows.select(array_to_vector("embedding").alias("features")))
    assert np.allclose(centres, plain.clusterCenters(), atol=1e-9)


def test_long_lists_are_cut(spark, vectors, monkeypatch):
    from quernstone.operators import vector_index

    monkeypatch.setattr(vector_index, "LIST", 10)
    queries = vectors.where("vec_id < 5")
    assert sorted(map(tuple, build(vectors, cells=3).nearest(queries, 5, 3).collect())) == sorted(map(tuple, nearest(vectors, queries, 5).collect()))
    with pytest.raises(ValueError):
        build(vectors.limit(0))


def test_sketch_sets_are_exact_above_the_size_of_a_sketch(spark, tmp_path):
    """200,000 orders: every fourth of them again in the later months."""
    rows = spark.range(250_000).select(
        F.lit("A").alias("l_returnflag"), F.pmod("id", F.lit(200_000)).alias("id"), F.when(F.col("id") < 200_000, F.lit("1996-03-05")).otherwise("1997-02-03").cast("timestamp_ntz").alias("l_shipdate")
    )
    rows.select("l_returnflag", "l_shipdate", F.floor(F.col("id") / 2).alias("l_partkey"), (F.col("id") * 4).alias("l_orderkey")).write.parquet(f"{tmp_path}/lineitem.parquet")
    (got,) = registry.QUERIES["sketch_sets"](spark, str(tmp_path)).collect()
    assert got.asDict() == {"l_returnflag": "A", "n": 200_000, "parts": 100_000, "orders": 200_000, "again": 50_000, "never_again": 150_000}
