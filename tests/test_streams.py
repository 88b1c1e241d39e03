"""Streams over several micro-batches: late rows, eviction, restarts and retries."""

from datetime import datetime, timedelta
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import functions as F

from quernstone.sinks.files import shared_path
from quernstone.streaming import state, windows
from quernstone.streaming.feeds import batch_sink, drained, fed, staged

START = datetime(2024, 1, 1)
SCHEMA = "batch int, event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def events(spark, rows):
    """rows: batch, minute, user, type, value."""
    return spark.createDataFrame([(b, i, START + timedelta(minutes=m), u, t, v) for i, (b, m, u, t, v) in enumerate(rows)], SCHEMA)


ROWS = [
    (0, 0, 1, "view", 1.0), (0, 10, 1, "click", 2.0), (0, 200, 2, "click", 1.0),
    (1, 195, 1, "view", 4.0), (1, 260, 1, "click", 3.0), (1, 250, 2, "click", 1.0),
    (2, 255, 1, "view", 0.5), (2, 600, 3, "view", 1.5), (2, 610, 4, "purchase", 0.0),
    (3, 5, 1, "click", 9.0),  # too late
    (4, 1000, -1, "click", 0.0), (4, 1000, -1, "view", 0.0),
]
#: user, number, first and last minute, events, cents, mean size of the last three
SESSIONS = [(1, 1, 0, 10, 2, 300, 2.0), (1, 2, 195, 195, 1, 400, 1.5), (1, 3, 255, 260, 2, 350, 5 / 3), (2, 1, 200, 200, 1, 100, 1.0), (2, 2, 250, 250, 1, 100, 1.0), (3, 1, 600, 600, 1, 150, 1.0), (4, 1, 610, 610, 1, 0, 1.0)]


def minutes(at):
    return int((at - START).total_seconds() // 60)


def sessions_of(frame):
    rows = frame.where("user_id > 0").withColumns({"s": F.col("session_start").cast("timestamp_ntz"), "e": F.col("session_end").cast("timestamp_ntz")}).collect()
    return sorted((r.user_id, r.number, minutes(r.s), minutes(r.e) - 30, r.n_events, r.cents, r.recent) for r in rows)


def test_idle_sessions_over_batches_and_a_restart(spark):
    rows = events(spark, ROWS)
    path, out, kept = (shared_path(spark, x) for x in ("feed", "out", "state"))
    run = lambda: drained(state.idle_sessions(fed(spark, path, rows)), "append", out, kept)
    staged(rows, F.col("batch"), 2, path=path)
    first = sessions_of(run())
    assert first and set(first) < set(SESSIONS)
    assert sessions_of(run()) == first  # nothing new to read: nothing is given out again
    staged(rows, F.col("batch"), 3, path=path, start=2)
    assert sessions_of(run()) == SESSIONS


def test_merging_of_late_rows():
    sessions = state.IdleSessions(10)
    assert sessions.merged([(0, 5, 2, 1), (20, 22, 1, 1)]) == [(0, 5, 2, 1), (20, 22, 1, 1)]
    assert sessions.merged([(0, 5, 2, 1), (20, 22, 1, 1), (13, 13, 1, 7)]) == [(0, 22, 4, 9)]
    assert sessions.merged([(0, 5, 2, 1), (15, 15, 1, 1)]) == [(0, 5, 2, 1), (15, 15, 1, 1)]
    assert sessions.due(1) == 1 and state.IdleSessions(1_000_000).due(500) == 1001


def test_first_seen_rows(spark):
    rows = events(spark, [(0, 0, 1, "view", 1.0), (0, 1, 1, "view", 1.0)])
    again = rows.unionAll(rows).unionAll(rows.withColumn("batch", F.lit(1)))
    path = staged(again, F.col("batch"), 2)
    got = drained(state.first_seen(fed(spark, path, again)), "append", without_data=False).collect()
    assert sorted(r.event_id for r in got) == [0, 1]


def test_outer_joined_streams_give_nulls_and_chained_counts(spark):
    rows = events(spark, ROWS)
    path = staged(rows, F.col("batch"), 5)
    two = lambda: (fed(spark, path, rows), fed(spark, path, rows))
    got = drained(windows.clicks_and_views(*two()), "append").where("click_id < 10").collect()
    assert sorted((r.click_id, r.view_id) for r in got) == [(1, 0), (2, None), (4, 6), (5, None)]
    hours = drained(windows.hours_of_lost_clicks(*two()), "append").collect()
    assert sorted((minutes(r.hour), r.n) for r in hours) == [(180, 1), (240, 1)]


def test_a_retried_batch_counts_once(spark):
    rows = events(spark, ROWS).select("user_id", "value")
    path = shared_path(spark, "out")
    for _ in range(2):
        batch_sink(path)(rows, 3)
    assert spark.read.parquet(path).count() == len(ROWS)
    feed = staged(events(spark, ROWS), F.col("batch"), 5)
    stream = fed(spark, feed, events(spark, ROWS))
    totals = drained(windows.running_totals(stream.select("user_id", "value")), "update").groupBy("user_id").agg(F.max("n").alias("n"))
    assert {r.user_id: r.n for r in totals.collect()} == {1: 6, 2: 2, 3: 1, 4: 1, -1: 2}
    counts = drained(stream.groupBy("user_id").count()).collect()
    assert sorted((r.user_id, r["count"]) for r in counts) == [(-1, 2), (1, 6), (2, 2), (3, 1), (4, 1)]


def test_a_feed_of_several_files_keeps_its_batches(spark):
    rows = events(spark, ROWS)
    path = staged(rows, F.col("batch"), 5, 3)
    assert spark.read.parquet(path).select(F.input_file_name()).distinct().count() == 15  # also of batches with fewer rows
    got = drained(windows.clicks_and_views(fed(spark, path, rows, 3), fed(spark, path, rows, 3)), "append").where("click_id < 10").collect()
    assert sorted((r.click_id, r.view_id) for r in got) == [(1, 0), (2, None), (4, 6), (5, None)]


def test_users_of_a_bucket_and_nobody_have_state_of_their_own(spark):
    nobody = [(0, 0, None, "view", 1.0), (0, 1, None, "view", 1.0)]
    rows = events(spark, ROWS + nobody)
    path = staged(rows, F.col("batch"), 5)
    stream = fed(spark, path, rows)
    sessions = drained(state.idle_sessions(stream, buckets=1), "append")
    assert sessions_of(sessions) == SESSIONS
    assert [(r.number, r.n_events) for r in sessions.where("user_id IS NULL").collect()] == [(1, 2)]
    totals = drained(windows.running_totals(stream.select("user_id", "value"), 1), "update").groupBy("user_id").agg(F.max("n").alias("n"), F.max("cents").alias("cents"))
    assert {r.user_id: (r.n, r.cents) for r in totals.collect()} == {1: (6, 1950), 2: (2, 200), 3: (1, 150), 4: (1, 0), -1: (2, 0), None: (2, 200)}
    seen = drained(state.first_seen(stream, buckets=1), "append", without_data=False)
    assert sorted((r.event_id, r.user_id) for r in seen.collect()) == [(i, r[2]) for i, r in enumerate(ROWS + nobody)]


class Held:
    """A value of state in memory that counts its calls."""

    def __init__(self, calls):
        self.calls, self.value = calls, None

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def clear(self):
        self.calls.append("clear")
        self.value = None


class Handle:
    def __init__(self):
        self.calls, self.timers = [], []

    def getValueState(self, name, schema):
        return Held(self.calls)

    def registerTimer(self, at):
        self.timers.append(at)


def test_a_thousand_users_cost_a_few_calls_of_the_store():
    sessions, handle = state.IdleSessions(10), Handle()
    sessions.init(handle)
    frame = pd.DataFrame({"user": list(range(1000)) * 2, "at": pd.to_datetime([0] * 1000 + [5] * 1000, unit="us"), "cents": [1] * 2000})
    list(sessions.handleInputRows((0,), iter([frame]), None))
    (out,) = sessions.handleExpiredTimer((0,), SimpleNamespace(getCurrentWatermarkInMs=lambda: 1), None)
    assert len(out) == 1000 and set(out["n_events"]) == {2} and handle.timers == [1] and len(handle.calls) < 10
