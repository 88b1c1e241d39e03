"""Streaming plans; each also runs on a batch frame of the same columns."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quernstone.streaming.state import BUCKETS, by_bucket

def _timed(events: DataFrame, late: str) -> DataFrame:
    """With the event time as a timestamp `at`, and its watermark on a stream."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp"))
    return timed.withWatermark("at", late) if timed.isStreaming else timed


def hourly(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Events and their value by hour and type. Events later than `late` behind the watermark are left out of a stream."""
    value = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    return _timed(events, late).groupBy(F.window("at", "1 hour").alias("hour"), "event_type").agg(F.count(F.lit(1)).alias("n"), value.alias("value")).select(F.col("hour.start").cast("timestamp_ntz").alias("hour"), "event_type", "n", "value")


def sliding(events: DataFrame, late: str = "10 minutes", width: str = "1 hour", step: str = "30 minutes") -> DataFrame:
    """Events by type in windows that overlap."""
    return _timed(events, late).groupBy(F.window("at", width, step).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


def user_sessions(events: DataFrame, late: str = "10 minutes", gap: str = "30 minutes") -> DataFrame:
    """Sessions by user."""
    found = _timed(events, late).groupBy(F.session_window("at", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n_events"))
    return found.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("session_start"), F.col("w.end").cast("timestamp_ntz").alias("session_end"), "n_events")


def distinct_events(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Events without those that repeat an id; a stream remembers ids for as long as its watermark allows."""
    timed = _timed(events, late)
    once = timed.dropDuplicatesWithinWatermark(["event_id"]) if timed.isStreaming else timed.dropDuplicates(["event_id"])
    return once.select("event_id", "user_id", "event_type")


def clicks_with_views(events: DataFrame, others: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Clicks joined with the same user's views of the half hour before: two streams, whose watermarks bound the rows kept."""
    return _with_views(events, others, late, "inner").select("click_id", "view_id")


def _with_views(events: DataFrame, others: DataFrame, late: str, how: str) -> DataFrame:
    clicks = _timed(events.where("event_type = 'click'"), late).select(F.col("user_id").alias("u"), F.col("event_id").alias("click_id"), F.col("at").alias("clicked"))
    views = _timed(others.where("event_type = 'view'"), late).select("user_id", F.col("event_id").alias("view_id"), F.col("at").alias("viewed"))
    return clicks.join(views, F.expr("u = user_id AND viewed BETWEEN clicked - INTERVAL 30 MINUTES AND clicked"), how)


def clicks_and_views(events: DataFrame, others: DataFrame, late: str = "10 minutes") -> DataFrame:
    """All clicks, each with the same user's views of the half hour before, or with a null once the watermark says that none can come."""
    return _with_views(events, others, late, "left_outer").select("click_id", "view_id")


def hours_of_lost_clicks(events: DataFrame, others: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Clicks without a view by hour: an aggregate over an outer join, each with its own eviction."""
    lost = _with_views(events, others, late, "left_outer").where("view_id IS NULL").select("clicked")
    return lost.groupBy(F.window("clicked", "1 hour").alias("hour")).agg(F.count(F.lit(1)).alias("n")).select(F.col("hour.start").cast("timestamp_ntz").alias("hour"), "n")


def _running(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Count and cents so far of a bucket's users; one row for each batch of a user."""
    totals = {user: (n, cents) for user, n, cents in zip(*state.get)} if state.exists else {}
    touched: set[int] = set()
    for frame in frames:
        cents = (frame["value"] * 100).round().groupby(frame["user"])
        for user, n, sum_ in zip(cents.size().index.tolist(), cents.size().tolist(), cents.sum().tolist()):
            before = totals.get(user, (0, 0))
            totals[user] = before[0] + n, before[1] + int(sum_)
            touched.add(user)
    state.update((list(totals), [n for n, _ in totals.values()], [cents for _, cents in totals.values()]))
    found = sorted(touched)
    users = pd.array(found if key[0] >= 0 else [None] * len(found), "Int64")
    yield pd.DataFrame({"user_id": users, "n": [totals[u][0] for u in found], "cents": [totals[u][1] for u in found]})


def running_totals(events: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Arbitrary state: each user's count and sum, updated batch by batch; the last row of a user holds all events so far. State is kept by bucket of users."""
    rows = by_bucket(events, buckets).select("bucket", "user", "value")
    return rows.groupBy("bucket").applyInPandasWithState(_running, "user_id long, n long, cents long", "users array<long>, n array<long>, cents array<long>", "update", GroupStateTimeout.NoTimeout)
