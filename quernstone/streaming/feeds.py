"""Feeding streams from files in a stated order, and draining them so that a retried or restarted run gives no row twice."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.sinks.files import shared_path

#: State on disk; a batch writes what it changed, and doesn't look up whether a key is new to count them.
STATE = {
    "spark__sql__streaming__stateStore__providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled": "true",
    "spark__sql__streaming__stateStore__rocksdb__trackTotalNumberOfRows": "false",
}


@contextmanager
def configured(spark: SparkSession, **settings: str) -> Iterator[None]:
    """The session with other settings (dots as double underscores) while streams start, and as it was after."""
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Rows that a file of a feed holds, about.
FILE_ROWS = 1 << 17
#: Numbers the one row of a feed's file that is no event; so each file is written, however few rows a batch has.
FILE = "_file"


def files_for(frame: DataFrame, batches: int) -> int:
    """Files a micro-batch, so that as many tasks write and read it as its rows ask for."""
    return max(1, -(-frame.count() // (batches * FILE_ROWS)))


def staged(frame: DataFrame, batch: Column, batches: int, files: int = 1, path: str | None = None, start: int = 0) -> str:
    """Writes the rows of batch `start`, then those of the next, and so on, each as `files` files, to a folder whose stream reads them in this order. Rows of no such batch are left out."""
    path = path or shared_path(frame.sparkSession, "feed")
    marks = frame.sparkSession.range(files, numPartitions=1).select(F.col("id").cast("int").alias(FILE))
    for number in range(start, start + batches):
        rows = frame.where(batch == number)
        if files == 1:
            rows = rows.repartition(1)
        else:
            dealt = rows.withColumns({FILE: F.lit(None).cast("int"), "_deal": F.pmod(F.monotonically_increasing_id(), F.lit(files)).cast("int")})
            marked = dealt.unionByName(marks.withColumn("_deal", F.col(FILE)), allowMissingColumns=True)
            rows = marked.repartitionById(files, F.col("_deal")).drop("_deal")
        rows.write.mode("append").parquet(path)
    return path


def fed(spark: SparkSession, path: str, like: DataFrame, files: int = 1) -> DataFrame:
    """The stream of a staged folder: a micro-batch reads `files` files, as many as were staged for it."""
    stream = spark.readStream.option("maxFilesPerTrigger", files)
    if files == 1:
        return stream.schema(like.schema).parquet(path)
    return stream.schema(T.StructType([*like.schema.fields, T.StructField(FILE, T.IntegerType())])).parquet(path).where(F.col(FILE).isNull()).drop(FILE)


def quarters(events: DataFrame, batches: int = 4, time: str = "ts") -> Column:
    """The number of a batch for each row: equal spans of time."""
    ends = events.agg(F.unix_micros(F.min(time).cast("timestamp")).alias("low"), F.unix_micros(F.max(time).cast("timestamp")).alias("high")).first()
    low, span = ends.low or 0, max(1, (ends.high or 0) - (ends.low or 0) + 1)
    return F.floor((F.unix_micros(F.col(time).cast("timestamp")) - low) * batches / span).cast("int")


def batch_sink(path: str):
    """For foreachBatch: a folder for each batch, written anew when the batch is retried, so that no attempt counts twice."""
    return lambda frame, number: frame.write.mode("overwrite").parquet(f"{path}/batch={number}")


def drained(frame: DataFrame, mode: str = "complete", path: str | None = None, state: str | None = None, without_data: bool = True) -> DataFrame:
    """A stream's result once all input there is has been read, as a batch frame.

    State and results are files in the shared folder, so nothing passes through the
    driver. Append mode goes through the file sink, which commits each batch once;
    update and complete mode through a folder for each batch, of which complete mode's
    last one is the result. With the same path and state a later call reads on where
    this one ended; its result holds the rows of all calls. without_data: whether batches
    without new rows run, which close what the watermark has passed; state that lives by
    processing time would ask for them for ever.
    """
    spark = frame.sparkSession
    path, state = path or shared_path(spark, "drained"), state or shared_path(spark, "state")
    writer = frame.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True)
    with configured(spark, **STATE, spark__sql__streaming__noDataMicroBatches__enabled=str(without_data).lower()):
        query = writer.format("parquet").option("path", path).start() if mode == "append" else writer.foreachBatch(batch_sink(path)).start()
        query.awaitTermination()
    if mode == "append":
        return spark.read.schema(frame.schema).parquet(path)
    found = spark.read.schema(frame.schema).option("basePath", path).parquet(f"{path}/batch=*")
    found = found if mode == "update" else found.where(F.col("batch") == found.agg(F.max("batch")).first()[0])
    return found.select(frame.columns)
