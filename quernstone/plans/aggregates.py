"""Aggregations: averages, distinct and filtered counts, statistics, rollups and grouping sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.operators import sketches
from quernstone.operators.quantiles import exact_quantiles
from quernstone.plans.catalog import query
from quernstone.sources.tables import table


@query("""
    SELECT l_returnflag, round(avg(l_quantity), 6) AS mean_qty, round(avg(l_discount), 6) AS mean_discount, min(l_extendedprice) AS least, max(l_extendedprice) AS most, bool_or(l_tax > 0.07) AS taxed
    FROM lineitem GROUP BY l_returnflag HAVING count(*) > 10""")
def item_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.avg("l_quantity"), 6).alias("mean_qty"), F.round(F.avg("l_discount"), 6).alias("mean_discount"), F.min("l_extendedprice").alias("least"), F.max("l_extendedprice").alias("most"), F.bool_or(F.col("l_tax") > 0.07).alias("taxed"), F.count(F.lit(1)).alias("n")
    )
    return found.where("n > 10").drop("n")


@query("""
    SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT (l_partkey, l_suppkey)) AS offers, count(DISTINCT l_orderkey) FILTER (l_quantity > 25) AS large_orders,
    count(*) FILTER (l_discount = 0) AS undiscounted, count(l_partkey) AS n FROM lineitem GROUP BY l_returnflag""")
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark expands distinct aggregates by column and counts in two steps, so that no task holds a group's values."""
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_partkey", "l_suppkey").alias("offers"),
        F.count_distinct(F.when(F.col("l_quantity") > 25, F.col("l_orderkey"))).alias("large_orders"),
        F.count_if(F.col("l_discount") == 0).alias("undiscounted"),
        F.count("l_partkey").alias("n"),
    )


@query("""
    SELECT l_linestatus, round(stddev_samp(l_quantity), 6) AS deviation, round(var_pop(l_quantity), 6) AS variance, round(corr(l_quantity, l_extendedprice), 6) AS correlation,
    round(covar_samp(l_quantity, l_extendedprice), 3) AS covariance, median(l_quantity) AS middle, round(quantile_cont(l_extendedprice, 0.9), 4) AS ninth,
    round((sum(l_quantity ** 3) / count(*) - 3 * avg(l_quantity) * sum(l_quantity ** 2) / count(*) + 2 * avg(l_quantity) ** 3) / var_pop(l_quantity) ** 1.5, 6) AS skew FROM lineitem GROUP BY l_linestatus""")
def item_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and percentile are exact, by counts of buckets; no task holds a group's values."""
    items = table(spark, sf_dir, "lineitem")
    moments = items.groupBy("l_linestatus").agg(
        F.round(F.stddev_samp("l_quantity"), 6).alias("deviation"),
        F.round(F.var_pop("l_quantity"), 6).alias("variance"),
        F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("correlation"),
        F.round(F.covar_samp("l_quantity", "l_extendedprice"), 3).alias("covariance"),
        F.round(F.skewness("l_quantity"), 6).alias("skew"),
    )
    middle = exact_quantiles(items, ["l_linestatus"], "l_quantity", [0.5]).select(F.col("l_linestatus").alias("s"), F.col("quantile").alias("middle"))
    ninth = exact_quantiles(items, ["l_linestatus"], "l_extendedprice", [0.9]).select(F.col("l_linestatus").alias("t"), F.round("quantile", 4).alias("ninth"))
    same = lambda c: F.col("l_linestatus").eqNullSafe(F.col(c))
    return moments.join(middle, same("s"), "left").join(ninth, same("t"), "left").drop("s", "t")


@query("SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, true AS near, true AS middle_near FROM lineitem GROUP BY l_returnflag")
def approximate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches against exact values: distinct parts within a tenth, the median quantity within one. Each kind has an aggregate of its own; beside a distinct count Spark would keep a sketch for each value."""
    items = table(spark, sf_dir, "lineitem")
    about = items.groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("about"), F.percentile_approx("l_quantity", 0.5).alias("about_middle"))
    parts = items.groupBy(F.col("l_returnflag").alias("f")).agg(F.count_distinct("l_partkey").alias("parts"))
    middle = exact_quantiles(items, ["l_returnflag"], "l_quantity", [0.5]).select(F.col("l_returnflag").alias("g"), F.col("quantile").alias("middle"))
    found = about.join(parts, F.col("l_returnflag").eqNullSafe(F.col("f"))).join(middle, F.col("l_returnflag").eqNullSafe(F.col("g")))
    return found.select("l_returnflag", "parts", (F.abs(F.col("about") - F.col("parts")) <= 0.1 * F.col("parts")).alias("near"), (F.abs(F.col("about_middle") - F.col("middle")) <= 1).alias("middle_near"))


@query("""
    SELECT coalesce(year(o_orderdate), 0) AS year, o_orderstatus, o_orderpriority, CAST(grouping_id(year(o_orderdate), o_orderstatus, o_orderpriority) AS BIGINT) AS level, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY ROLLUP (year(o_orderdate), o_orderstatus, o_orderpriority)""")
def order_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate").cast("long"))
    return orders.rollup("year", "o_orderstatus", "o_orderpriority").agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")).withColumn("year", F.coalesce("year", F.lit(0).cast("long")))


@query("""
    SELECT o_orderstatus, o_orderpriority, CAST(grouping_id(o_orderstatus, o_orderpriority) AS BIGINT) AS level, count(*) AS n
    FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderpriority), ())""")
def order_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return orders.groupingSets([[status, priority], [priority], []], status, priority).agg(F.grouping_id("o_orderstatus", "o_orderpriority").alias("level"), F.count(F.lit(1)).alias("n"))


@query("""
    SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names, arg_max(n_name, n_nationkey) AS last_name, CAST(len(list(DISTINCT length(n_name))) AS INT) AS lengths FROM nation GROUP BY n_regionkey""")
def nation_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(
        F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("names"), F.max_by("n_name", "n_nationkey").alias("last_name"), F.size(F.collect_set(F.length("n_name"))).alias("lengths")
    )


def _months() -> Column:
    return F.date_format("l_shipdate", "yyyy-MM")


@query("""
    WITH i AS (SELECT *, strftime(l_shipdate, '%Y-%m') AS month FROM lineitem), early AS (SELECT * FROM i WHERE month BETWEEN '1996-02' AND '1996-10'), late AS (SELECT * FROM i WHERE month BETWEEN '1997-01' AND '1998-06')
    SELECT l_returnflag, count(*) AS n, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders,
        (SELECT count(*) FROM (SELECT l_orderkey FROM early e WHERE e.l_returnflag = x.l_returnflag INTERSECT SELECT l_orderkey FROM late l WHERE l.l_returnflag = x.l_returnflag)) AS again,
        (SELECT count(*) FROM (SELECT l_orderkey FROM early e WHERE e.l_returnflag = x.l_returnflag EXCEPT SELECT l_orderkey FROM late l WHERE l.l_returnflag = x.l_returnflag)) AS never_again
    FROM early x GROUP BY l_returnflag""")
def sketch_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct parts and orders of some months, and orders that came again or never again in others, from stored sketches of single months. Values are dealt into buckets of few enough for a theta sketch to be exact; buckets have no value in common, so their counts add up."""
    items, spans = table(spark, sf_dir, "lineitem"), (("1996-02", "1996-10"), ("1997-01", "1998-06"))
    parts, orders = (sketches.buckets(items, c) for c in ("l_partkey", "l_orderkey"))
    by = ["l_returnflag", "bucket"]
    by_part = sketches.store(items.withColumn("bucket", parts), _months(), by, theta_of=["l_partkey"])
    by_order = sketches.store(items.withColumn("bucket", orders), _months(), by, theta_of=["l_orderkey"])
    early, late = (sketches.merged(spark, by_order, *span, by) for span in spans)
    late = late.select(F.col("l_returnflag").alias("flag"), F.col("bucket").alias("of"), F.col("theta_l_orderkey").alias("late"))
    both = early.join(late, F.col("l_returnflag").eqNullSafe(F.col("flag")) & (F.col("bucket") == F.col("of")), "left")
    count, held = F.theta_sketch_estimate, F.col("theta_l_orderkey")
    again = F.when(F.col("late").isNotNull(), count(F.theta_intersection(held, F.col("late")))).otherwise(0)
    found = both.groupBy("l_returnflag").agg(F.sum("rows").alias("n"), F.sum(count(held)).alias("orders"), F.sum(again).alias("again"))
    seen = sketches.merged(spark, by_part, *spans[0], by).groupBy(F.col("l_returnflag").alias("f")).agg(F.sum(count("theta_l_partkey")).alias("parts"))
    return found.join(seen, F.col("l_returnflag").eqNullSafe(F.col("f"))).select("l_returnflag", "n", "parts", "orders", "again", (F.col("orders") - F.col("again")).alias("never_again"))


@query()
def sketch_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates from stored sketches of months, merged over a year and a half, with their errors: distinct orders, and quantiles of the price."""
    path = sketches.store(table(spark, sf_dir, "lineitem"), _months(), ["l_returnflag"], ["l_orderkey"], ["l_extendedprice"])
    found = sketches.estimated(sketches.merged(spark, path, "1996-01", "1997-06", ["l_returnflag"]), [0.1, 0.5, 0.9])
    error = sketches.errors()
    return found.select("l_returnflag", F.col("rows").alias("n"), F.col("hll_l_orderkey").alias("orders"), F.lit(error["hll"]).alias("orders_error"), F.col("kll_l_extendedprice").alias("prices"), F.lit(error["kll"]).alias("prices_rank_error"))
