"""Mergeable sketches as stored columns: distinct counts and quantiles of any span of periods without the rows they were made from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.sinks.files import shared_path

#: Sizes as powers of two (HLL, theta) and the KLL parameter.
HLL, THETA, KLL = 14, 16, 200


def errors(hll: int = HLL, theta: int = THETA, kll: int = KLL) -> dict[str, float]:
    """The standard error of counts, relative to them, and the error of a quantile's rank, relative to the number of rows, that 99 of 100 keep. A theta sketch of fewer values than its size is exact."""
    return {"hll": 1.04 / 2 ** (hll / 2), "theta": 1 / (2**theta - 1) ** 0.5, "kll": 2.296 / kll**0.9723}


def store(frame: DataFrame, period: Column, by: Sequence[str] = (), distinct: Sequence[str] = (), spread: Sequence[str] = (), path: str | None = None, hll: int = HLL, theta: int = THETA, kll: int = KLL, theta_of: Sequence[str] = ()) -> str:
    """Writes a row of sketches for each period and group, partitioned by period: rows, and for each column hll_ and theta_ (distinct), theta_ alone (theta_of) or kll_ (spread, as doubles).

    Sketches are merged in the tasks that read the rows, so that a group sends a sketch
    a task. Writing again replaces the periods that are written and no others. Null
    values don't count; a null period is a period that no span holds.
    """
    path = path or shared_path(frame.sparkSession, "sketches")
    made = [F.count(F.lit(1)).alias("rows")]
    made += [x for c in distinct for x in (F.hll_sketch_agg(F.col(f"`{c}`"), F.lit(hll)).alias(f"hll_{c}"), F.theta_sketch_agg(F.col(f"`{c}`"), F.lit(theta)).alias(f"theta_{c}"))]
    made += [F.theta_sketch_agg(F.col(f"`{c}`"), F.lit(theta)).alias(f"theta_{c}") for c in theta_of]
    made += [F.kll_sketch_agg_double(F.col(f"`{c}`").cast("double"), F.lit(kll)).alias(f"kll_{c}") for c in spread]
    sketches = frame.groupBy(period.alias("period"), *[F.col(f"`{b}`") for b in by]).agg(*made)
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)
    return path


def buckets(frame: DataFrame, column: str, theta: int = THETA) -> Column:
    """A bucket for each value of a column, of about a quarter at most of the distinct values for which a theta sketch is exact. A bucket's share strays from that by a hundredth or so and the count it rests on by some hundredths."""
    values = frame.agg(F.approx_count_distinct(f"`{column}`").alias("n")).first().n
    return F.pmod(F.xxhash64(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))), F.lit(max(1, -(-4 * values // 2**theta)))).cast("int")


def merged(spark: SparkSession, path: str, low: object, high: object, by: Sequence[str] = (), theta: int = THETA) -> DataFrame:
    """by, rows and the merged sketches of the periods from low to high; only their folders are read."""
    found = spark.read.parquet(path).where(F.col("period").between(F.lit(low), F.lit(high)))
    unions = {"hll_": F.hll_union_agg, "theta_": lambda c: F.theta_union_agg(c, F.lit(theta)), "kll_": F.kll_merge_agg_double}
    made = [f(F.col(f"`{c}`")).alias(c) for c in found.columns for start, f in unions.items() if c.startswith(start)]
    return found.groupBy(*[F.col(f"`{b}`") for b in by]).agg(F.sum("rows").alias("rows"), *made)


def estimated(sketches: DataFrame, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """The merged rows with estimates for sketches: hll_ and theta_ as counts, kll_ as an array of the quantiles asked for."""
    read = {
        "hll_": F.hll_sketch_estimate,
        "theta_": F.theta_sketch_estimate,
        "kll_": lambda c: F.kll_sketch_get_quantile_double(c, F.array(*[F.lit(float(q)) for q in quantiles])),
    }
    chosen = lambda c: next((f for start, f in read.items() if c.startswith(start)), None)
    return sketches.select(*[chosen(c)(F.col(f"`{c}`")).alias(c) if chosen(c) else F.col(f"`{c}`") for c in sketches.columns])
