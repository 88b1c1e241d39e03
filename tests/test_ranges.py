"""Ranks, running sums and quantiles against Spark's own windows and plain sorting."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quernstone.operators.quantiles import exact_quantiles
from quernstone.operators.ranks import dealt, ranked


def some_rows(spark):
    draw = random.Random(1)
    rows = [(draw.choice(["a", "a", "a", "b", None]), draw.choice([None, 1, 1, 1, 2, 3, 5, 5, 5, 5, 5, 9]), draw.choice([None, 1, 2, 3]), i) for i in range(400)]
    return spark.createDataFrame([*rows, ("z", None, None, 1000), ("y", 7, 1, 1001)], "g string, o long, x long, i long")


@pytest.mark.parametrize("by", [["g"], []])
@pytest.mark.parametrize("up", [True, False])
def test_ranks_with_ties_over_borders(spark, by, up):
    frame = some_rows(spark)
    order = F.col("o").asc_nulls_first() if up else F.col("o").desc_nulls_last()
    w = Window.partitionBy(*by).orderBy(order)
    want = frame.select("i", F.rank().over(w), F.dense_rank().over(w), F.percent_rank().over(w), F.cume_dist().over(w), F.sum("x").over(w))
    got = ranked(frame, by, [("o", up)], {"s": "x"}, parts=9).select("i", "rank", "dense_rank", "percent_rank", "cume_dist", "s_peers")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("by", [["g"], []])
def test_numbers_tiles_and_running_sums(spark, by):
    frame = some_rows(spark)
    w = Window.partitionBy(*by).orderBy(F.col("o").desc_nulls_last(), "i")
    want = frame.select("i", F.row_number().over(w), F.ntile(7).over(w), F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.rank().over(w))
    got = ranked(frame, by, [("o", False), ("i", True)], {"s": "x"}, tiles=7, parts=9).select("i", "row_number", "ntile", "s", "rank")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert ranked(frame.limit(0), by, [("o", True)]).collect() == []


def test_a_hot_value_is_dealt_over_ranges(spark):
    """Nine rows of ten in one group and of one value: no range holds much more than its share."""
    frame = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(7).alias("o"), F.lit("g").alias("g")).repartition(4)
    sizes = [r["count"] for r in dealt(frame, ["g"], [("o", True)], 8).groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8


@pytest.mark.parametrize(("rounds", "buckets"), [(3, 4096), (3, 4), (1, 4), (0, 4)])
@pytest.mark.parametrize("by", [["g"], []])
def test_quantiles_against_sorting(spark, by, rounds, buckets):
    draw = random.Random(2)
    rows = [(draw.choice(["a", "a", "b", None]), draw.choice([draw.gauss(0, 1), draw.gauss(0, 1) * 1e200, 5.0, 5.0, None, float("inf"), 1e-300])) for _ in range(1500)]
    rows += [("n", float("nan")), ("n", 1.0), ("n", 2.0), ("one", 3.0), ("none", None), ("low", float("-inf")), ("low", 1.0), ("low", 2.0)]
    shares = [0, 0.5, 0.9, 1, 0.333]
    found = exact_quantiles(spark.createDataFrame(rows, "g string, v double").repartition(5), by, "v", shares, rounds, buckets).collect()
    got = {(r.g if by else "", r.probability): r.quantile for r in found}
    want = {}
    for g in {k for k, _ in rows} if by else {""}:
        values = np.sort([v for k, v in rows if v is not None and (not by or k == g)])
        for p in shares if len(values) else ():
            at = (len(values) - 1) * p
            low, high = values[int(np.floor(at))], values[int(np.ceil(at))]
            want[g, p] = low if at == int(at) else low + (high - low) * (at - int(at))
    assert got.keys() == want.keys() and all(np.isclose(got[k], want[k], rtol=1e-12, atol=0, equal_nan=True) for k in want)


def test_quantiles_of_nothing(spark):
    frame = spark.createDataFrame([("a", None)], "g string, v double")
    assert exact_quantiles(frame, ["g"], "v", [0.5]).collect() == []
    with pytest.raises(ValueError):
        exact_quantiles(frame, ["g"], "v", [1.5])
