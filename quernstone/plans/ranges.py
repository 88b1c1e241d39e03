"""Queries by ranges: ranks and quantiles of hot groups, overlapping intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions.columns import money
from quernstone.operators.joins import overlap_join
from quernstone.operators.quantiles import exact_quantiles
from quernstone.operators.ranks import ranked
from quernstone.plans.catalog import query
from quernstone.sources.tables import table


@query("""
    SELECT l_linestatus, l_extendedprice, rank, dense_rank, percent_rank, cume_dist, CAST(quantity AS DOUBLE) AS quantity, count(*) AS n FROM (
        SELECT l_linestatus, l_extendedprice, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank, round(percent_rank() OVER w, 9) AS percent_rank, round(cume_dist() OVER w, 9) AS cume_dist,
            sum(CAST(l_quantity AS DECIMAL(18,2))) OVER w AS quantity FROM lineitem WINDOW w AS (PARTITION BY l_linestatus ORDER BY l_extendedprice)) GROUP BY ALL""")
def item_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items of two groups by price, with ties, and the quantity up to each price."""
    items = table(spark, sf_dir, "lineitem").select("l_linestatus", "l_extendedprice", money("l_quantity").alias("q"))
    found = ranked(items, ["l_linestatus"], [("l_extendedprice", True)], {"quantity": "q"})
    found = found.select("l_linestatus", "l_extendedprice", "rank", "dense_rank", F.round("percent_rank", 9).alias("percent_rank"), F.round("cume_dist", 9).alias("cume_dist"), F.col("quantity_peers").cast("double").alias("quantity"))
    return found.groupBy(*found.columns).agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT o_orderkey, row_number() OVER w AS place, ntile(100) OVER w AS percentile, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS total
    FROM orders WINDOW w AS (ORDER BY o_totalprice DESC, o_orderkey)""")
def order_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders in one order, without a group: numbers, hundredths and running totals."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", money("o_totalprice").alias("price"))
    found = ranked(orders, [], [("o_totalprice", False), ("o_orderkey", True)], {"total": "price"}, tiles=100)
    return found.select("o_orderkey", F.col("row_number").alias("place"), F.col("ntile").alias("percentile"), F.col("total").cast("double").alias("total"))


@query("""
    SELECT l_returnflag, unnest([0.1, 0.5, 0.9, 0.99])::DOUBLE AS probability, round(unnest(q), 4) AS quantile FROM (SELECT l_returnflag, quantile_cont(l_extendedprice, [0.1, 0.5, 0.9, 0.99]) AS q FROM lineitem GROUP BY l_returnflag)""")
def item_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles of the price by return flag."""
    found = exact_quantiles(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", [0.1, 0.5, 0.9, 0.99])
    return found.withColumn("quantile", F.round("quantile", 4))


@query("""
    WITH spans AS (SELECT event_id, user_id, event_type, ts AS low, ts + INTERVAL 1 MINUTE * CAST(floor(value) AS INT) AS high FROM events)
    SELECT p.event_id AS purchase, e.event_id AS error FROM spans p JOIN spans e ON p.user_id = e.user_id AND p.low <= e.high AND e.low <= p.high WHERE p.event_type = 'purchase' AND e.event_type = 'error'""")
def overlapping_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases and errors of a user as spans of as many minutes as their value: those that have a moment in common."""
    events = table(spark, sf_dir, "events")
    high = F.col("ts") + F.make_interval(mins=F.floor("value").cast("int"))
    spans = lambda kind, n: events.where(F.col("event_type") == kind).select(F.col("event_id").alias(kind), F.col("user_id").alias(f"u{n}"), F.col("ts").alias(f"low{n}"), high.alias(f"high{n}"))
    return overlap_join(spans("purchase", 1), spans("error", 2), [("u1", "u2")], ("low1", "high1"), ("low2", "high2")).select("purchase", "error")


@query("""
    SELECT a.o_orderkey AS urgent, b.o_orderkey AS low FROM orders a JOIN orders b ON a.o_orderdate <= b.o_orderdate + INTERVAL 3 DAY AND b.o_orderdate <= a.o_orderdate + INTERVAL 3 DAY
    WHERE a.o_orderpriority = '1-URGENT' AND b.o_orderpriority = '5-LOW' AND a.o_totalprice > 430000 AND b.o_totalprice > 430000""")
def overlapping_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large urgent orders and large orders of low priority, each open for three days, that were open at one time: intervals without a key, many with one beginning."""
    orders = table(spark, sf_dir, "orders").where("o_totalprice > 430000")
    spans = lambda kind, name, n: orders.where(F.col("o_orderpriority") == kind).select(F.col("o_orderkey").alias(name), F.col("o_orderdate").alias(f"low{n}"), (F.col("o_orderdate") + F.expr("INTERVAL 3 DAYS")).alias(f"high{n}"))
    return overlap_join(spans("1-URGENT", "urgent", 1), spans("5-LOW", "low", 2), [], ("low1", "high1"), ("low2", "high2")).select("urgent", "low")
