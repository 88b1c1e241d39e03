"""Frames written to the shared folder and read again, so that lineage is short and later plans know their size."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quernstone.sinks.files import shared_path


def settled(frame: DataFrame, name: str) -> DataFrame:
    """The frame as Parquet below spark.checkpoint.dir: lost executors cost no recomputation, and a small one is broadcast by its size."""
    path = shared_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
