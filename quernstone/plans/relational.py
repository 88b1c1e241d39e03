"""Relational queries. Each plan leaves join order, broadcasts and partial aggregation to Catalyst and AQE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quernstone.functions.columns import dot, money
from quernstone.operators.groups import sessions, top_k
from quernstone.operators.joins import asof_join, interval_join
from quernstone.plans.catalog import query
from quernstone.sources.tables import table
from quernstone.streaming import windows

HOURLY = "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM events GROUP BY ALL"


@query("""
    SELECT r_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue, count(*) AS n_items
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01' GROUP BY r_name""")
def revenue_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discounted revenue of the orders of 1996 by region."""
    t = lambda name: table(spark, sf_dir, name)
    price = money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    orders = t("orders").where((F.col("o_orderdate") >= "1996-01-01") & (F.col("o_orderdate") < "1997-01-01"))
    return (
        t("lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name")
        .agg(F.sum(price).cast("double").alias("revenue"), F.count(F.lit(1)).alias("n_items"))
    )


@query("""
    SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price, count(*) AS n, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-09-02' GROUP BY ALL""")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= "2000-09-02")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(money("l_quantity")).cast("double").alias("sum_qty"), F.sum(money("l_extendedprice")).cast("double").alias("sum_price"), F.count(F.lit(1)).alias("n"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
    )


@query("""
    SELECT p_partkey, p_name, p_size FROM part WHERE p_size BETWEEN 10 AND 20 AND p_brand IN ('Brand#11', 'Brand#22', 'Brand#33') AND p_name LIKE '%a%'""")
def part_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = F.col("p_size").between(10, 20) & F.col("p_brand").isin("Brand#11", "Brand#22", "Brand#33") & F.col("p_name").like("%a%")
    return table(spark, sf_dir, "part").where(kept).select("p_partkey", "p_name", "p_size")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def orders_without_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey", "o_orderpriority")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def large_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = table(spark, sf_dir, "orders").where("o_totalprice > 400000")
    return table(spark, sf_dir, "customer").join(large, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("""
    SELECT n_name, count(DISTINCT c_custkey) AS customers, count(DISTINCT s_suppkey) AS suppliers FROM nation
    LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name""")
def nation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted before the join, so that customers and suppliers of a nation never pair up."""
    customers = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count_distinct("c_custkey").alias("customers"))
    suppliers = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.count_distinct("s_suppkey").alias("suppliers"))
    joined = table(spark, sf_dir, "nation").join(customers, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(suppliers, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return joined.select("n_name", F.coalesce("customers", F.lit(0)).alias("customers"), F.coalesce("suppliers", F.lit(0)).alias("suppliers"))


@query("""
    SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag) AS INT) AS no_flag, CAST(grouping(l_linestatus) AS INT) AS no_status, count(*) AS n,
    CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def item_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus")
    return cube.agg(F.grouping("l_returnflag").cast("int").alias("no_flag"), F.grouping("l_linestatus").cast("int").alias("no_status"), F.count(F.lit(1)).alias("n"), F.sum(money("l_quantity")).cast("double").alias("qty"))


@query("""
    SELECT o_custkey, o_orderkey, o_totalprice, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3""")
def top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey", "o_totalprice", "rank")


@query("""
    SELECT event_id, user_id, lag(event_type) OVER w AS before, coalesce(lead(event_id) OVER w, -1) AS next_id,
    CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS DOUBLE) AS last_five
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select("event_id", "user_id", F.lag("event_type").over(by).alias("before"), F.coalesce(F.lead("event_id").over(by), F.lit(-1)).alias("next_id"), F.sum(money("value")).over(by.rowsBetween(-4, 0)).cast("double").alias("last_five"))


@query("""
    SELECT b.event_id, b.user_id, coalesce(v.event_id, -1) AS view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') b
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON b.user_id = v.user_id AND b.ts >= v.ts""")
def purchase_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the user's latest view before it, -1 where there is none."""
    events = table(spark, sf_dir, "events")
    views = events.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id"))
    return asof_join(events.where("event_type = 'purchase'"), views, "user_id", "ts", "ts", ["view_id"]).select("event_id", "user_id", F.coalesce("view_id", F.lit(-1)).alias("view_id"))


@query("""
    SELECT e.event_id AS error_id, c.event_id AS click_id FROM events e JOIN events c ON e.user_id = c.user_id
    AND c.event_type = 'click' AND c.ts BETWEEN e.ts - INTERVAL 1 HOUR AND e.ts WHERE e.event_type = 'error'""")
def clicks_before_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks in the hour before an error of the same user."""
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    events = table(spark, sf_dir, "events")
    clicks = events.where("event_type = 'click'").select(F.col("event_id").alias("click_id"), F.col("user_id").alias("u"), seconds.alias("at"))
    errors = events.where("event_type = 'error'").select(F.col("event_id").alias("error_id"), F.col("user_id").alias("v"), seconds.alias("until"))
    return interval_join(clicks, errors, [("u", "v")], F.col("at"), F.col("until") - 3600, F.col("until"), 3600).select("error_id", "click_id")


@query("""
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n_events FROM (
        SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS number FROM (
            SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, number""")
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions(table(spark, sf_dir, "events"), "user_id", "ts", "30 minutes")


@query(HOURLY)
def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.hourly(table(spark, sf_dir, "events"))


@query("""
    SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal > 0 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 0
    EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey = 0""")
def nation_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_nationkey").alias("nationkey"))
    suppliers = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select("s_nationkey")
    return customers.intersect(suppliers).subtract(table(spark, sf_dir, "nation").where("n_regionkey = 0").select("n_nationkey"))


@query("""
    SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error, count(*) FILTER (event_type = 'purchase') AS purchase,
    count(*) FILTER (event_type = 'signup') AS signup, count(*) FILTER (event_type = 'view') AS "view" FROM events GROUP BY user_id""")
def event_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = ["click", "error", "purchase", "signup", "view"]
    return table(spark, sf_dir, "events").groupBy("user_id").pivot("event_type", kinds).count().na.fill(0, kinds)


@query("SELECT CAST(json_extract_string(props, '$.k') AS INT) AS k, count(*) AS n FROM events GROUP BY 1")
def event_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.get_json_object("props", "$.k").cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month, date_trunc('quarter', o_orderdate) AS quarter, upper(substr(o_orderpriority, 1, 3)) AS head, length(o_orderpriority) AS chars,
    CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'middle' ELSE 'low' END AS price FROM orders""")
def order_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(F.col("o_totalprice") > 300000, "high").when(F.col("o_totalprice") > 100000, "middle").otherwise("low")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").cast("long").alias("year"), F.month("o_orderdate").cast("long").alias("month"), F.date_trunc("quarter", "o_orderdate").cast("timestamp_ntz").alias("quarter"), F.upper(F.substring("o_orderpriority", 1, 3)).alias("head"), F.length("o_orderpriority").cast("long").alias("chars"), price.alias("price")
    )


@query("""
    SELECT vec_id, label, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 6) AS squares, CAST(len(list_filter(embedding, lambda x: x > 0)) AS INT) AS positive FROM embeddings""")
def vector_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.round(dot(vector, vector), 6).alias("squares"), F.size(F.filter(vector, lambda x: x > 0)).alias("positive"))
