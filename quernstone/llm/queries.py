"""The queries opN_<name> of the training-data operators and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.llm import bpe, chat, exact, infill, maxent, mixing, neardup, ngramjoin, ordermin, quality, spelling, transducer, warc
from quernstone.llm.common import documents, tokenizer_path


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _digests(codec: bpe.RankArrayCodec, text: str, ids: list[int]) -> dict:
    return {"n_tokens": len(ids), "ids_sha256": sha256(",".join(map(str, ids))), "decoded_sha256": sha256(codec.decode(ids))}


DIGESTS = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), per_row=_digests, schema=DIGESTS)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels.where(~quality.held_out(F.col("doc_id"), 5, 0)))
    return quality.score(docs, model).select("doc_id", quality.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir), width=3, percent=85)


#: The tools that conversations may call.
TOOLS = {
    "search": {"type": "object", "properties": {"query": {"type": "string"}, "limit": {"type": "integer"}, "after": {"type": "object"}}, "required": ["query"], "additionalProperties": False},
    "calculate": {"type": "object", "properties": {"expression": {"type": "string"}}, "required": ["expression"], "additionalProperties": False},
}


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links the calls and results that are planted in all conversations; the tables' own call no tools."""
    return chat.format_chats(chat.planted(spark.read.parquet(f"{sf_dir}/conversations.parquet")), TOOLS)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.deduplicate(documents(spark, sf_dir))


def op7_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = quality.held_out(F.col("doc_id"), 7, 2)
    scored = maxent.score(docs, maxent.Trained(docs.where(~held)))
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = transducer.count_tokens(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits a replica with planted damage against the records of all pages."""
    manifest = warc.records(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return warc.report(manifest, warc.damaged(manifest, F.pmod("id", F.lit(101)) == 7, F.pmod("id", F.lit(211)) == 5))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordermin.compare_with_next(documents(spark, sf_dir))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(documents(spark, sf_dir)))


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.restore(infill.transform(documents(spark, sf_dir)))
    digest = lambda column: F.sha2(F.col(column).cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output").alias("output_sha256"), digest("restored").alias("restored_sha256"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.Join(documents(spark, sf_dir), width=4, percent=85).components()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_quality": op2_quality,
    "op3_mixing": op3_mixing,
    "op4_near_dedup": op4_near_dedup,
    "op5_chat": op5_chat,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_maxent": op7_maxent,
    "op8_token_counts": op8_token_counts,
    "op9_warc": op9_warc,
    "op10_order_minhash": op10_order_minhash,
    "op11_spelling": op11_spelling,
    "op12_infill": op12_infill,
    "op13_ngram_join": op13_ngram_join,
}

ORACLE_SQL: dict[str, str] = {
    "op5_chat": chat.SQL,
    "op6_exact_dedup": exact.SQL,
    "op9_warc": warc.SQL,
    "op12_infill": infill.SQL,
}
