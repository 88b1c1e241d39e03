"""Grouping operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(frame: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group. Spark filters by rank before the shuffle too, so that a group sends k rows a task."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return frame.withColumn("rank", rank).where(F.col("rank") <= k)


def sessions(frame: DataFrame, by: str, time: str, gap: str) -> DataFrame:
    """Sessions by key: start, end, number of rows. A session ends when `gap` passes without a row."""
    window = F.session_window(F.col(time), gap)
    return frame.groupBy(by, window.alias("session")).agg(F.count(F.lit(1)).alias("n_events")).select(by, F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"), "n_events")
