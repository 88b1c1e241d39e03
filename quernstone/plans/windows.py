"""Ranking and analytic windows, range frames, global order, and batch time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quernstone.plans.catalog import query
from quernstone.sources.tables import table
from quernstone.streaming import windows as timed


@query("""
    SELECT p_partkey, CAST(rank() OVER w AS INT) AS rank, CAST(dense_rank() OVER w AS INT) AS dense, CAST(ntile(4) OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS INT) AS quarter,
    round(percent_rank() OVER w, 9) AS percent, round(cume_dist() OVER w, 9) AS share FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_size)""")
def part_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = Window.partitionBy("p_brand")
    size = by.orderBy("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.rank().over(size).alias("rank"), F.dense_rank().over(size).alias("dense"), F.ntile(4).over(by.orderBy("p_size", "p_partkey")).alias("quarter"), F.round(F.percent_rank().over(size), 9).alias("percent"), F.round(F.cume_dist().over(size), 9).alias("share")
    )


@query("""
    SELECT event_id, first_value(event_type) OVER w AS first_type, last_value(event_type) OVER (w ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS later_type, coalesce(nth_value(event_id, 3) OVER w, -1) AS third,
    lag(value, 2, -1.0) OVER w AS two_before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def event_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select(
        "event_id", F.first("event_type").over(by).alias("first_type"), F.last("event_type").over(by.rowsBetween(0, 2)).alias("later_type"), F.coalesce(F.nth_value("event_id", 3).over(by), F.lit(-1)).alias("third"), F.lag("value", 2, -1.0).over(by).alias("two_before")
    )


@query("""
    SELECT event_id, count(*) OVER w AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) AS total
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 21600000000 PRECEDING AND 3600000000 FOLLOWING)""")
def hours_around(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range frame: from six hours before each event of a user to one hour after it."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    by = Window.partitionBy("user_id").orderBy("micros").rangeBetween(-6 * 3_600_000_000, 3_600_000_000)
    return table(spark, sf_dir, "events").withColumn("micros", micros).select("event_id", F.count(F.lit(1)).over(by).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).over(by).cast("double").alias("total"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def largest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A global top-k: each task keeps k rows, no full sort."""
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("""
    SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderpriority NULLS LAST, o_orderdate DESC, o_orderkey) AS BIGINT) AS place FROM orders
    ORDER BY o_orderpriority NULLS LAST, o_orderdate DESC, o_orderkey LIMIT 20 OFFSET 40""")
def orders_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of a sorted table; the place is counted on the page's few rows only."""
    order = [F.asc_nulls_last("o_orderpriority"), F.desc("o_orderdate"), F.asc("o_orderkey")]
    page = table(spark, sf_dir, "orders").orderBy(*order).offset(40).limit(20)
    return page.select("o_orderkey", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)) + 40).cast("long").alias("place"))


SLIDING = """
    SELECT start, event_type, count(*) AS n FROM (
        SELECT event_type, time_bucket(INTERVAL 30 MINUTE, ts) AS start FROM events
        UNION ALL SELECT event_type, time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE FROM events) GROUP BY ALL"""


@query(SLIDING)
def sliding_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed.sliding(table(spark, sf_dir, "events"))
