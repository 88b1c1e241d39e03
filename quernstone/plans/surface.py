"""User-defined functions: scalar, Arrow-batched, grouped, grouped maps and table functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import udfs
from quernstone.plans.catalog import query
from quernstone.sources.tables import table

#: Parts of a group that Python aggregates.
SALTS = 64


@query("SELECT p_partkey, lpad(regexp_extract(p_brand, '([0-9]+)$', 1), 4, '0') AS code FROM part")
def scalar_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", udfs.brand_code("p_brand").alias("code"))


@query("SELECT l_orderkey, l_partkey, round(l_extendedprice * (1 - l_discount), 4) AS price FROM lineitem WHERE l_quantity = 50")
def batch_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where("l_quantity = 50").select("l_orderkey", "l_partkey", F.round(udfs.discounted("l_extendedprice", "l_discount"), 4).alias("price"))


@query("SELECT p_brand, max(p_retailprice) - min(p_retailprice) AS spread FROM part GROUP BY p_brand")
def grouped_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each brand in SALTS parts first, so that no worker holds a brand."""
    parts = table(spark, sf_dir, "part").withColumn("salt", F.pmod(F.xxhash64("p_partkey"), F.lit(SALTS)))
    partly = parts.groupBy("p_brand", "salt").agg(udfs.least("p_retailprice").alias("low"), udfs.most("p_retailprice").alias("high"))
    return partly.groupBy("p_brand").agg((F.max("high") - F.min("low")).alias("spread"))


def _ranked(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.assign(place=frame["s_acctbal"].rank(method="min", ascending=False).astype("int64"))[["s_suppkey", "place"]]


@query("SELECT s_suppkey, rank() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC) AS place FROM supplier")
def grouped_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").groupBy("s_nationkey").applyInPandas(_ranked, "s_suppkey long, place long")


@query("""
    SELECT p_partkey, CAST(part - 1 AS INT) AS part, word FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word, generate_subscripts(string_split(p_name, ' '), 1) AS part FROM part)""")
def table_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return parts.lateralJoin(udfs.WordsOf(F.col("p_name").outer())).select("p_partkey", "part", "word")
