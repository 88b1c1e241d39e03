"""Exact quantiles by group, without a group's values in one place.

Values are counted by buckets between a group's least and greatest, in the tasks
that read them; the buckets that hold the wanted ranks are cut again, and only their
values go on. After ROUNDS such scans, each of at most as many values as the one
before, what is left is counted value by value and summed over ranges (ranks.py),
which is exact for any values, so that the rounds only save work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.operators.ranks import ranked, same_keys
from quernstone.operators.settled import settled

ROUNDS, BUCKETS = 3, 1 << 12


def _bucket(buckets: int) -> Column:
    """The bucket of v between low and high: greater values never have lesser buckets. Infinite values and NaN, which no range holds, have buckets of their own."""
    scaled = F.floor((F.col("v") - F.col("low")) * (F.lit(float(buckets)) / (F.col("high") - F.col("low"))))
    inside = F.when(F.col("high") > F.col("low"), F.least(scaled, F.lit(buckets - 1))).otherwise(0)
    return F.when(F.isnan("v"), buckets + 1).when(F.col("v") > F.col("high"), buckets).when((F.col("v") < F.col("low")) | F.col("low").isNull(), -1).otherwise(inside).cast("long")


def exact_quantiles(frame: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float], rounds: int = ROUNDS, buckets: int = BUCKETS) -> DataFrame:
    """by, probability, quantile: the linearly interpolated quantiles of a numeric column.

    Null values don't count, and a group without values has no row; a null group is a
    group; NaN is the greatest value. Values are taken as doubles.
    """
    if not all(0 <= p <= 1 for p in probabilities):
        raise ValueError(f"not all between 0 and 1: {probabilities}")
    keys = [f"k{i}" for i in range(len(by))]
    data = frame.select(*[F.col(f"`{b}`").alias(k) for b, k in zip(by, keys)], F.col(f"`{value}`").cast("double").alias("v")).where("v IS NOT NULL")
    finite = F.when(~F.isnan("v") & (F.abs("v") < float("inf")), F.col("v"))
    groups = settled(data.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(finite).alias("low"), F.max(finite).alias("high")), "groups")
    place = lambda p: (F.col("n") - 1) * F.lit(float(p))
    ranks = F.array_distinct(F.array(*[f(place(p)).cast("long") for p in probabilities for f in (F.floor, F.ceil)]))
    cells = groups.select(*keys, F.lit(0).cast("long").alias("cell"), "low", "high", F.lit(0).cast("long").alias("before"), ranks.alias("ranks"))
    rows, answers = data.withColumn("cell", F.lit(0).cast("long")), []
    group = [*keys, "cell"]
    named = lambda f, suffix: f.withColumnsRenamed({k: k + suffix for k in group})
    on = lambda suffix: same_keys([F.col(k) for k in group], [F.col(k + suffix) for k in group])
    for _ in range(rounds):
        dealt = rows.join(named(cells.select(*group, "low", "high"), "_c"), on("_c")).select(*group, "v", _bucket(buckets).alias("bucket"))
        counts = dealt.groupBy(*group, "bucket").agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
        passed = F.coalesce(F.sum("c").over(Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a cell has buckets + 3 rows at most
        found = counts.withColumn("passed", passed).join(named(cells.select(*group, "before", "ranks"), "_c"), on("_c")).withColumn("before", F.col("before") + F.col("passed"))
        found = found.withColumn("ranks", F.filter("ranks", lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("c")))).where(F.size("ranks") > 0)
        found = settled(found.select(*group, "bucket", "least", "most", "before", "ranks"), "buckets")
        answers.append(found.where("least = most").select(*keys, F.explode("ranks").alias("rank"), F.col("least").alias("v")))
        open_ = found.where("least <> most")
        if open_.isEmpty():
            break
        deeper = (F.col("cell") * (buckets + 3) + F.col("bucket") + 1).alias("cell")
        kept = named(open_.select(*group, F.col("bucket").alias("bucket_c")), "_c")
        rows = settled(dealt.join(kept, on("_c") & (F.col("bucket") == F.col("bucket_c"))).select(*keys, deeper, "v"), "candidates")
        cells = open_.select(*keys, deeper, F.col("least").alias("low"), F.col("most").alias("high"), "before", "ranks")
    else:
        counted = rows.groupBy(*group, "v").agg(F.count(F.lit(1)).alias("c"))
        summed = ranked(counted, group, [("v", True)], {"through": "c"}).select(*group, "v", "c", "through")
        last = summed.join(named(cells.select(*group, "before", "ranks"), "_c"), on("_c")).withColumn("end", F.col("before") + F.col("through"))
        held = F.filter("ranks", lambda r: (r >= F.col("end") - F.col("c")) & (r < F.col("end")))
        answers.append(last.select(*keys, F.explode(held).alias("rank"), "v"))
    values = answers[0]
    for more in answers[1:]:
        values = values.unionByName(more)
    wanted = groups.select(*keys, F.explode(F.array(*[F.struct(F.lit(float(p)).alias("p"), place(p).alias("at")) for p in probabilities])).alias("w")).select(*keys, "w.p", "w.at")
    low = values.select(*[F.col(k).alias(f"{k}_l") for k in keys], F.col("rank").alias("rank_l"), F.col("v").alias("v_l"))
    high = values.select(*[F.col(k).alias(f"{k}_h") for k in keys], F.col("rank").alias("rank_h"), F.col("v").alias("v_h"))
    for side, f, s in ((low, F.floor, "_l"), (high, F.ceil, "_h")):
        wanted = wanted.join(side, same_keys([F.col(k) for k in keys], [F.col(k + s) for k in keys]) & (f("at").cast("long") == F.col(f"rank{s}")))
    part = F.col("at") - F.floor("at")
    between = F.when(part == 0, F.col("v_l")).otherwise(F.col("v_l") + (F.col("v_h") - F.col("v_l")) * part)
    return wanted.select(*[F.col(k).alias(b) for k, b in zip(keys, by)], F.col("p").alias("probability"), between.alias("quantile"))
