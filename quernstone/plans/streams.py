"""Structured Streaming queries over the event table, fed in several micro-batches and drained into files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.operators.settled import settled
from quernstone.plans.catalog import query
from quernstone.plans.relational import HOURLY
from quernstone.plans.windows import SLIDING
from quernstone.sources.tables import table
from quernstone.streaming import state, windows
from quernstone.streaming.feeds import drained, fed, files_for, quarters, staged

#: Micro-batches that a stream query reads its events in.
BATCHES = 4
#: Batches of the feed with late rows, the last of which closes what is open.
LATE_BATCHES = 6
#: Rows of a bucket of users in a micro-batch, about.
BUCKET_ROWS = 1 << 12


def _buckets(spark: SparkSession, sf_dir: str, batches: int) -> int:
    """Buckets of users, so many that a micro-batch has about BUCKET_ROWS rows in each."""
    return max(1, -(-table(spark, sf_dir, "events").count() // (batches * BUCKET_ROWS)))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream, a quarter of their time after the other."""
    events = table(spark, sf_dir, "events")
    files = files_for(events, BATCHES)
    return fed(spark, staged(events, quarters(events, BATCHES), BATCHES, files), events, files)


def _late_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The events as two equal streams, in fifths of their time, with late rows and a batch that closes what is open.

    Every second event of a minute that ends a fifth comes with the next one, as the
    watermark allows. Of the first two fifths, events whose id leaves 5 modulo 97 come
    with the last, which is too late. The closing batch holds a click and a view of
    nobody, long after all others, so that the watermark passes them.
    """
    events = table(spark, sf_dir, "events")
    fifths = LATE_BATCHES - 1
    at = quarters(events, fifths)
    ends = settled(events.groupBy(at.alias("fifth")).agg(F.max("ts").alias("end")), "ends")
    placed = events.withColumn("fifth", at).join(F.broadcast(ends), "fifth")  # as many rows as fifths
    behind = (F.col("event_id") % 2 == 0) & (F.col("ts") >= F.col("end") - F.expr("INTERVAL 1 MINUTE"))
    number = F.when((F.col("event_id") % 97 == 5) & (F.col("fifth") < 2), fifths - 1).when(behind & (F.col("fifth") < fifths - 1), F.col("fifth") + 1).otherwise(F.col("fifth"))
    last = events.agg((F.max("ts") + F.expr("INTERVAL 10 DAYS")).alias("ts"))
    closing = last.select(F.lit(-1).cast("long").alias("event_id"), "ts", F.lit(-1).cast("long").alias("user_id"), F.explode(F.array(F.lit("click"), F.lit("view"))).alias("event_type"), F.lit(0.0).alias("value"), F.lit("{}").alias("props"))
    rows = placed.select(*events.columns, number.alias("batch")).unionByName(closing.withColumn("batch", F.lit(fifths)))
    files = files_for(events, fifths)
    path = staged(rows, F.col("batch"), LATE_BATCHES, files)
    return fed(spark, path, rows, files).drop("batch"), fed(spark, path, rows, files).drop("batch")


#: The events that are not too late, in SQL.
IN_TIME = f"""
    ends AS (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) - epoch_us(min(ts)) + 1 AS span FROM events),
    in_time AS (SELECT events.* FROM events, ends WHERE NOT (event_id % 97 = 5 AND CAST(floor((epoch_us(ts) - low) * {LATE_BATCHES - 1} / span) AS INT) < 2))"""


@query(HOURLY)
def hourly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drained(windows.hourly(_events(spark, sf_dir)))


@query(SLIDING)
def sliding_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drained(windows.sliding(_events(spark, sf_dir)))


@query("""
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n_events FROM (
        SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS number FROM (
            SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, number""")
def session_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drained(windows.user_sessions(_events(spark, sf_dir)))


@query("SELECT DISTINCT event_id, user_id, event_type FROM events")
def distinct_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream holds every event twice, the second time a micro-batch later."""
    events = table(spark, sf_dir, "events")
    rows = events.withColumn("batch", quarters(events, BATCHES)).withColumn("batch", F.explode(F.array("batch", F.col("batch") + 1)))
    files = files_for(rows, BATCHES + 1)
    return drained(windows.distinct_events(fed(spark, staged(rows, F.col("batch"), BATCHES + 1, files), rows, files)), "append")


@query("""
    SELECT c.event_id AS click_id, v.event_id AS view_id FROM events c JOIN events v ON c.user_id = v.user_id AND v.ts BETWEEN c.ts - INTERVAL 30 MINUTE AND c.ts
    WHERE c.event_type = 'click' AND v.event_type = 'view'""")
def joined_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    files = files_for(events, BATCHES)
    path = staged(events, quarters(events, BATCHES), BATCHES, files)
    return drained(windows.clicks_with_views(fed(spark, path, events, files), fed(spark, path, events, files)), "append")


@query("SELECT user_id, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY user_id")
def stateful_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's last row is the one with most events."""
    rows = drained(windows.running_totals(_events(spark, sf_dir).select("user_id", "value"), _buckets(spark, sf_dir, BATCHES)), "update")
    return rows.groupBy("user_id").agg(F.max("n").alias("n"), F.max_by("cents", "n").alias("cents"))


@query(f"""
    WITH {IN_TIME}, marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM in_time),
    numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS number FROM marked),
    sessions AS (SELECT user_id, CAST(number AS BIGINT) AS number, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n_events, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM numbered GROUP BY user_id, number)
    SELECT *, round(avg(n_events) OVER (PARTITION BY user_id ORDER BY number ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS recent FROM sessions""")
def idle_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions ended by inactivity, from value, list and map state and event-time timers, over six micro-batches with late rows."""
    found = drained(state.idle_sessions(_late_events(spark, sf_dir)[0], buckets=_buckets(spark, sf_dir, LATE_BATCHES - 1)), "append").where("user_id <> -1")
    return found.withColumns({"session_start": F.col("session_start").cast("timestamp_ntz"), "session_end": F.col("session_end").cast("timestamp_ntz"), "recent": F.round("recent", 6)})


@query("SELECT user_id, event_id, event_type FROM events")
def first_seen_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is sent again a micro-batch later; map state with a time to live tells."""
    events = table(spark, sf_dir, "events")
    rows = events.withColumn("batch", quarters(events, 2)).withColumn("batch", F.explode(F.array("batch", F.col("batch") + 1)))
    files = files_for(rows, 3)
    return drained(state.first_seen(fed(spark, staged(rows, F.col("batch"), 3, files), rows, files), buckets=_buckets(spark, sf_dir, 2)), "append", without_data=False)


@query(f"""
    WITH {IN_TIME} SELECT c.event_id AS click_id, coalesce(v.event_id, -1) AS view_id FROM (SELECT * FROM in_time WHERE event_type = 'click') c
    LEFT JOIN (SELECT * FROM in_time WHERE event_type = 'view') v ON c.user_id = v.user_id AND v.ts BETWEEN c.ts - INTERVAL 30 MINUTE AND c.ts""")
def outer_joined_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks with their views, or with -1 for the null that eviction gives out, over six micro-batches with late rows."""
    found = drained(windows.clicks_and_views(*_late_events(spark, sf_dir)), "append").where("click_id <> -1")
    return found.withColumn("view_id", F.coalesce("view_id", F.lit(-1)))


@query(f"""
    WITH {IN_TIME} SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM in_time c WHERE event_type = 'click' AND NOT EXISTS
    (SELECT 1 FROM in_time v WHERE v.event_type = 'view' AND v.user_id = c.user_id AND v.ts BETWEEN c.ts - INTERVAL 30 MINUTE AND c.ts) GROUP BY 1""")
def lost_clicks_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks without a view by hour: an aggregate over a stream join."""
    return drained(windows.hours_of_lost_clicks(*_late_events(spark, sf_dir)), "append")
