"""Sinks with read-back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.plans.catalog import query
from quernstone.sinks.files import round_trip, shared_path
from quernstone.sinks.tables import bucketed, overwrite_partitions
from quernstone.sources.tables import table

ITEMS = "SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders WHERE o_totalprice > 300000"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_totalprice > 300000").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")


@query(ITEMS)
def parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_orders(spark, sf_dir), "parquet", ["o_orderstatus"])


@query(ITEMS)
def orc_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_orders(spark, sf_dir), "orc")


@query(ITEMS)
def json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_orders(spark, sf_dir), "json")


@query(ITEMS)
def csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_orders(spark, sf_dir), "csv")


#: Buckets of the query's tables; a table of 100 TB wants as many as make files of a few hundred MB.
BUCKETS = 16


@query("""
    SELECT o_orderkey, o_orderpriority, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderpriority""")
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items joined to orders and grouped by order on tables with equal buckets: no shuffle after the tables are written."""
    orders = bucketed(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), ["o_orderkey"], BUCKETS)
    items = bucketed(table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("price")), ["l_orderkey"], BUCKETS)
    joined = orders.hint("merge").join(items, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("price").cast("double").alias("price"))


@query("""
    SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CASE WHEN year(o_orderdate) = 1997 THEN -o_totalprice ELSE o_totalprice END AS price FROM orders WHERE year(o_orderdate) IN (1996, 1997) AND NOT (year(o_orderdate) = 1997 AND o_orderstatus = 'P')""")
def overwritten_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by year, of which one year is then replaced; two years are read, and no folder of another."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("price"))
    path = shared_path(spark, "by_year")
    overwrite_partitions(orders, path, ["year"])
    overwrite_partitions(orders.where("year = 1997 AND o_orderstatus <> 'P'").withColumn("price", -F.col("price")), path, ["year"])
    return spark.read.schema(orders.schema).parquet(path).where("year IN (1996, 1997)").select("o_orderkey", "year", "price")
