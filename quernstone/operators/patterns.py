"""Sequences of events, found by an automaton that a polymorphic table function runs over ordered rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


class _Sequences:
    """One row for each event that ends a sequence: its columns are the ids of the steps, named after them, so that the schema depends on the arguments.

    For each step the automaton holds the sequence up to it that began last: an event
    of a step's kind goes on from what the step before holds. So an event that ends a
    sequence ends the one of latest beginning, and if that is too old all are.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument, steps: AnalyzeArgument, within: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable or not isinstance(steps.value, str) or len(steps.value.split(",")) < 2:
            raise ValueError("a table, at least two kinds of events with commas between, and seconds are wanted")
        kind = {f.name: f.dataType for f in rows.dataType.fields}["id"]
        names = [f"{step}_{i + 1}" for i, step in enumerate(steps.value.split(","))]
        return AnalyzeResult(T.StructType([T.StructField(n, kind) for n in names]))

    def __init__(self):
        self.held = None

    def eval(self, row: Row, steps: str, within: int) -> Iterator[tuple]:
        kinds = steps.split(",")
        if self.held is None:
            self.held = [None] * len(kinds)
        for i in reversed([i for i, kind in enumerate(kinds) if kind == row["kind"]]):
            before = self.held[i - 1] if i else (row["at"], ())
            if before is not None:
                self.held[i] = before[0], (*before[1], row["id"])
                if i == len(kinds) - 1 and row["own"] and row["at"] - before[0] <= within * 1_000_000:
                    yield self.held[i][1]


def sequences(events: DataFrame, by: str, time: str, id_col: str, kind_col: str, steps: Sequence[str], within: int) -> DataFrame:
    """For each event of the last kind, the sequence of `steps` that ends with it, lies within so many seconds and began last; a column of ids for each step, as <step>_<number>.

    Time is cut into ranges of `within` seconds. A range's rows run after those of the
    range before, which hold whatever a sequence that ends in it may have begun with;
    so a key of any number of events is spread over its ranges. Events of one moment
    are in the order of their ids. Null keys, times and kinds take no part.
    """
    if any("," in s for s in steps):
        raise ValueError("kinds with commas")
    rows = events.select(F.col(f"`{by}`").alias("key"), F.unix_micros(F.col(f"`{time}`").cast("timestamp")).alias("at"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{kind_col}`").alias("kind"))
    rows = rows.where(F.col("key").isNotNull() & F.col("at").isNotNull() & F.col("kind").isin(*steps)).withColumn("range", F.floor(F.col("at") / (within * 1_000_000)))
    placed = rows.select("key", "at", "id", "kind", F.posexplode(F.array(F.col("range"), F.col("range") + 1)).alias("carried", "range")).withColumn("own", F.col("carried") == 0)
    run = F.udtf(_Sequences)
    return run(placed.asTable().partitionBy("key", "range").orderBy("at", "id"), F.lit(",".join(steps)), F.lit(within))
