"""Set operations with and without duplicates, pivots and unpivots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.plans.catalog import query
from quernstone.sources.tables import table


def _keys(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customers = table(spark, sf_dir, "customer").where("c_acctbal > 8000").select(F.col("c_nationkey").alias("key"))
    return customers, table(spark, sf_dir, "supplier").where("s_acctbal > 2000").select(F.col("s_nationkey").alias("key"))


BOTH = "(SELECT c_nationkey AS key FROM customer WHERE c_acctbal > 8000) {} (SELECT s_nationkey AS key FROM supplier WHERE s_acctbal > 2000)"


@query(BOTH.format("UNION ALL"))
def keys_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _keys(spark, sf_dir)
    return a.unionAll(b)


@query(BOTH.format("UNION"))
def keys_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _keys(spark, sf_dir)
    return a.unionByName(b).distinct()


@query(BOTH.format("INTERSECT ALL"))
def keys_intersect_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _keys(spark, sf_dir)
    return a.intersectAll(b)


@query(BOTH.format("EXCEPT ALL"))
def keys_except_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _keys(spark, sf_dir)
    return a.exceptAll(b)


@query("""
    SELECT l_orderkey, l_partkey, l_linenumber, measure, amount FROM (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem WHERE l_quantity > 49)
    UNPIVOT (amount FOR measure IN (l_quantity, l_discount, l_tax))""")
def item_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where("l_quantity > 49").unpivot(["l_orderkey", "l_partkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "measure", "amount")


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey")
def first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least order of each customer. An aggregate, since dropDuplicates keeps an arbitrary row."""
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"))
