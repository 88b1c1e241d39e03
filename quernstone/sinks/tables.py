"""Bucketed and partitioned tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from quernstone.sinks.files import shared_path


def bucketed(frame: DataFrame, by: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """The frame as a table of files by hash of the columns, each file sorted by them, read again.

    Two such tables with as many buckets join, and one is grouped, by these columns
    without a shuffle. The rows are dealt to the buckets' tasks first, so that there is
    one file a bucket. The catalog forgets the table at once; its files stay.
    """
    spark, name = frame.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    path = path or shared_path(spark, "bucketed")
    columns = [f"`{c}`" for c in by]
    frame.repartition(buckets, *columns).write.format("parquet").option("path", path).bucketBy(buckets, *by).sortBy(*by).saveAsTable(name)
    found = spark.table(name)
    found.schema  # resolved with its buckets before the name goes
    spark.sql(f"DROP TABLE {name}")
    return found


def overwrite_partitions(frame: DataFrame, path: str, by: Sequence[str]) -> None:
    """Writes the frame's partitions in place of those of the same values; all others stay."""
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
