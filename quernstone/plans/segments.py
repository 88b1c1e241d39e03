"""Tables written as segments of JSON lines by the data source, and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.plans.catalog import query
from quernstone.sinks.files import shared_path
from quernstone.sources import segments
from quernstone.sources.tables import table

#: Bytes of a segment of orders: so small that the smallest tables have several.
SEGMENT = 1 << 16


@query("""
    SELECT o_orderkey, o_orderdate, o_orderpriority, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-07-01'""")
def segment_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in segments by ranges of their date, of which a half-year's filter opens those that may hold it."""
    path = shared_path(spark, "segments")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    segments.write(orders.repartitionByRange("o_orderdate").sortWithinPartitions("o_orderdate"), path, segment_bytes=SEGMENT)
    return segments.read(spark, path).where("o_orderdate >= timestamp_ntz'1996-01-01' AND o_orderdate < timestamp_ntz'1996-07-01'")


@query("SELECT doc_id, source, length(text) AS chars, md5(text) AS digest FROM documents")
def segment_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts in two commits after one that is overwritten, read in ranges that cut segments within lines."""
    path = shared_path(spark, "segments")
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    segments.write(documents.select("doc_id"), path)
    segments.write(documents.where("lang = 'en'"), path, overwrite=True)
    segments.write(documents.where("lang IS DISTINCT FROM 'en'"), path)
    found = segments.read(spark, path, range_bytes=1 << 20)
    return found.select("doc_id", "source", F.length("text").cast("long").alias("chars"), F.md5("text").alias("digest"))


@query("""
    SELECT source, lang, count(*) AS n, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS chars, CAST(max(doc_id) AS BIGINT) AS last FROM documents GROUP BY source, lang""")
def segment_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in three commits, each taken by a stream that begins again where it ended, and written once; then grouped."""
    source, sink, checkpoint = (shared_path(spark, "segments") for _ in range(3))
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    for part in range(3):
        segments.write(documents.where(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3)) == part), source)
        segments.drain(source, sink, "lengths", spark, checkpoint, lambda frame: frame.select("doc_id", "source", "lang", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars")))
    found = segments.read(spark, sink)
    return found.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.max("doc_id").alias("last"))
