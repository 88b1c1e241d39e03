"""Named tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The tables of a data directory.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"no table {name!r}")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Registers tables as temporary views, for SQL."""
    for name in names or TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
