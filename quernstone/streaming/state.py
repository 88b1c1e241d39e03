"""Operators that keep state of their own by key (transformWithState), in RocksDB."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

SESSIONS = "user_id long, number long, session_start timestamp, session_end timestamp, n_events long, cents long, recent double"


#: Buckets that the users of a stream are dealt into, where the caller names no other number.
BUCKETS = 64


def by_bucket(events: DataFrame, buckets: int) -> DataFrame:
    """With the user's bucket, and the user as a number that is never null: a null one is 0 in bucket -1, alone.

    A call of the state API from Python costs about a millisecond, so state is kept by
    bucket. Its users are rewritten together; there should be as many buckets as keep
    them to some thousands of rows a batch. The number belongs to the stream's state and
    stays for its restarts.
    """
    user = F.col("user_id")
    return events.withColumns({"bucket": F.when(user.isNull(), -1).otherwise(F.pmod(F.xxhash64(user), F.lit(buckets))).cast("int"), "user": F.coalesce(user, F.lit(0)).cast("long")})


class IdleSessions(StatefulProcessor):
    """Sessions of a bucket's users, given out when the watermark says that nothing can join them any more.

    One value holds the open sessions: late rows, as far as the watermark lets them in,
    may widen one or join two. Another counts the sessions given out by user and keeps
    the sizes of the last KEPT of them. One timer a bucket, in event time, is set for the
    session that ends first; when it fires, all that the watermark has passed are given
    out at once, so that a bucket costs a few calls of the store a batch, however many
    users it has and however many of their sessions end.
    """

    KEPT = 3

    def __init__(self, gap: int):
        self.gap = gap  # microseconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "user array<long>, start array<long>, last array<long>, n array<long>, cents array<long>")
        self.closed = handle.getValueState("closed", "user array<long>, number array<long>, recent array<array<long>>")

    def held(self) -> dict[int, list[tuple]]:
        """The open sessions of each user."""
        spans: dict[int, list[tuple]] = {}
        for user, *span in zip(*self.open.get()) if self.open.exists() else ():
            spans.setdefault(user, []).append(tuple(span))
        return spans

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        spans = self.held()
        for frame in rows:
            at, touched = frame["at"].to_numpy().astype("datetime64[us]").astype("int64").tolist(), set()
            for user, t, cents in zip(frame["user"].tolist(), at, frame["cents"].tolist()):
                spans.setdefault(user, []).append((t, t, 1, cents))
                touched.add(user)
            for user in touched:
                spans[user] = self.merged(spans[user])
        self.kept(spans)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        spans, passed = self.held(), timerValues.getCurrentWatermarkInMs()
        done = {user: [s for s in sorted(found) if self.due(s[1]) <= passed] for user, found in spans.items()}
        if not any(done.values()):  # an earlier timer gave these out, or the session went on
            yield pd.DataFrame()
            return
        closed = {user: (number, list(recent)) for user, number, recent in zip(*self.closed.get())} if self.closed.exists() else {}
        out = []
        for user, found in done.items():
            for start, last, n, cents in found:
                number, recent = closed.get(user, (0, []))
                closed[user] = number, recent = number + 1, [*recent, n][-self.KEPT :]
                out.append((user if key[0] >= 0 else None, number, start, last + self.gap, n, cents, sum(recent) / len(recent)))
        self.closed.update((list(closed), [number for number, _ in closed.values()], [recent for _, recent in closed.values()]))
        self.kept({user: [s for s in found if self.due(s[1]) > passed] for user, found in spans.items()})
        frame = pd.DataFrame(out, columns=["user_id", "number", "session_start", "session_end", "n_events", "cents", "recent"])
        yield frame.assign(session_start=pd.to_datetime(frame["session_start"], unit="us"), session_end=pd.to_datetime(frame["session_end"], unit="us"))

    def kept(self, spans: dict[int, list[tuple]]) -> None:
        """Writes the open sessions, and sets the timer of the one that ends first."""
        flat = [(user, *span) for user, found in spans.items() for span in found]
        if flat:
            self.open.update(tuple(map(list, zip(*flat))))
            self.handle.registerTimer(min(self.due(s[2]) for s in flat))
        else:
            self.open.clear()

    def close(self) -> None:
        pass

    def due(self, last: int) -> int:
        """The first millisecond at which a session with this last moment has ended."""
        return -(-(last + self.gap) // 1000)

    def merged(self, spans: list[tuple]) -> list[tuple]:
        out: list[tuple] = []
        for start, last, n, cents in sorted(spans):
            if out and start - out[-1][1] < self.gap:
                first, end, m, sum_ = out[-1]
                out[-1] = (first, max(end, last), m + n, sum_ + cents)
            else:
                out.append((start, last, n, cents))
        return out


def idle_sessions(events: DataFrame, late: str = "10 minutes", gap_minutes: int = 30, buckets: int = BUCKETS) -> DataFrame:
    """user_id, number (the user's sessions in order), session_start, session_end, n_events, cents, recent (mean size of the last three): a stream in append mode."""
    cents = F.round(F.col("value") * 100).cast("long").alias("cents")
    timed = by_bucket(events, buckets).select("bucket", "user", F.col("ts").cast("timestamp").alias("at"), cents).withWatermark("at", late)
    return timed.groupBy("bucket").transformWithStateInPandas(IdleSessions(gap_minutes * 60 * 1_000_000), SESSIONS, "Append", "EventTime")


class FirstSeen(StatefulProcessor):
    """The first row of each user and id of a bucket. A map holds them by ranges of WIDTH ids; a range that got no new id for as long as the state lives is forgotten."""

    WIDTH = 1 << 20

    def __init__(self, lives_ms: int):
        self.lives_ms = lives_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "range long", "users array<long>, ids array<long>", self.lives_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        held: dict[int, set[tuple[int, int]]] = {}
        fresh: set[int] = set()
        for frame in rows:
            kept = []
            for pair in zip(frame["user"].tolist(), frame["event_id"].tolist()):
                at = pair[1] // self.WIDTH
                if at not in held:
                    held[at] = set(zip(*self.seen.getValue((at,)))) if self.seen.containsKey((at,)) else set()
                kept.append(pair not in held[at])
                if kept[-1]:
                    held[at].add(pair)
                    fresh.add(at)
            found = frame.loc[kept, ["user", "event_id", "event_type"]].rename(columns={"user": "user_id"})
            yield found if key[0] >= 0 else found.assign(user_id=pd.array([None] * len(found), "Int64"))
        for at in fresh:
            self.seen.updateValue((at,), tuple(map(list, zip(*held[at]))))

    def close(self) -> None:
        pass


def first_seen(events: DataFrame, hours: int = 24, buckets: int = BUCKETS) -> DataFrame:
    """user_id, event_id, event_type without a user's repeated ids, which live in state for some hours of processing time."""
    rows = by_bucket(events, buckets).select("bucket", "user", "event_id", "event_type")
    return rows.groupBy("bucket").transformWithStateInPandas(FirstSeen(hours * 3_600_000), events.select("user_id", "event_id", "event_type").schema, "Append", "ProcessingTime")
