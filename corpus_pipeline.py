"""A training corpus from documents: quality, exact and near duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs. All but the last return the
columns of documents, extra and clashing ones too, by place.

A decision holds for the rows of one id (null is an id too) and one text, so
rows that repeat an id with other texts are documents of their own. Decisions
reach the documents by a table of marks: only rows whose text may be dropped or
repeated are joined, all others pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.llm import bpe, exact, mixing, neardup, quality
from quernstone.llm.common import Marks, cleaning, discard, places, settle, shared_folder, tokenizer_path

#: Documents that score below are rejected.
QUALITY = 0.3


def one_of_each(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of docs whose id and text own their group; of rows alike in both the one whose columns, as JSON, have the least hash, wherever they lie.

    decided: doc_id, text_key (the text's 64-bit hash, a null text taken as empty) and owner of each row of docs.
    """
    groups = decided.groupBy("doc_id", "text_key").agg(F.max("owner").alias("owner"), F.count(F.lit(1)).alias("rows"))
    groups = settle(groups.where("NOT owner OR rows > 1").select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"), "owner"), "decided")
    marks = Marks(groups.select("of_key"))
    test = marks.tester()

    @F.pandas_udf("boolean")
    def marked(cells: pd.Series) -> pd.Series:
        return pd.Series(test(cells.to_numpy()))

    names = docs.columns
    id_at, text_at = places(names, "doc_id", "text")
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    keyed = plain.withColumn("key", F.xxhash64(F.coalesce(F.col(f"c{text_at}").cast("string"), F.lit(""))))
    keyed = keyed.withColumn("number", F.col(f"c{id_at}").cast("long")).withColumn("marked", marked(marks.cell(F.col("key"))))
    stays = keyed.where("marked").join(groups.where("NOT owner"), F.col("number").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key")), "left_anti")
    first = Window.partitionBy("number", "key").orderBy(F.xxhash64(F.to_json(F.struct(*plain.columns))))
    stays = stays.withColumn("place", F.row_number().over(first)).where("place = 1")
    return keyed.where("NOT marked").select(plain.columns).union(stays.select(plain.columns)).toDF(*names)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score at least QUALITY. A null text is scored as an empty one; repeated rows stay repeated; an empty table stays empty."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels.where(~quality.held_out(F.col("doc_id"), 5, 0)))
    return quality.select(docs, model, QUALITY)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal without blanks: the one with most code points, then the smallest id (a null one last), then the least hash of its text. Null, empty and blank texts are one group."""
    return one_of_each(docs, exact.deduplicate(docs, keyed=True))


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates (five words, 0.8): the smallest id's, then the least hash of its text. Texts without words and rows of null ids stand alone; rows alike in id and text are one."""
    return one_of_each(docs, neardup.near_duplicates(docs, keyed=True))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight says; the budget is the tokens there are. A null source is a source; one without tokens is left out; rows alike in id and text have as many copies each."""
    return mixing.deal(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of each row's text; a null or empty text has no ids."""
    schema = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return bpe.encode(docs, tokenizer_path("byte_bpe_50k.json"), per_row=lambda codec, text, ids: {"n_tokens": len(ids), "ids": ids}, schema=schema)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]

#: A trained classifier, sketches and a tokenizer are not SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other. What a stage wrote besides its result is deleted once that is written, and a stage's result once the next one's is."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = shared_folder(spark, f"stage-{name}")
        with cleaning(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        docs.settled_at = path
        if before is not None:
            discard(before)
        before = docs
    return docs
