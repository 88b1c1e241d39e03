"""An inverted index of vectors: k-means cells, every row in the list of its nearest cell, searches in the lists of a few cells."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernstone.operators.settled import settled
from quernstone.operators.vectors import BLOCK, best_of

#: Vectors that the cells are fitted on, and cells, at most.
SAMPLE, CELLS = 100_000, 4096
#: Rows of a list that a task searches; longer lists are cut.
LIST = 1 << 16


@dataclass
class VectorIndex:
    rows: DataFrame  # id, v, cell: all rows
    centres: np.ndarray

    def nearest(self, queries: DataFrame, k: int, probes: int, id_col: str = "vec_id", vector_col: str = "embedding", places: int = 6) -> DataFrame:
        """query_id, id, similarity, rank: of the rows in the `probes` cells nearest to a query, the k with the largest inner product, its own id left out. With as many probes as cells the result is exact.

        Queries are dealt into blocks for each cell, long lists into blocks of LIST rows;
        a block of both meets in one task. A query that is there twice is answered twice.
        """
        cells = settled(_read(queries, id_col, vector_col, self.centres.shape[1]).withColumn("number", F.monotonically_increasing_id()).withColumn("cell", F.explode(_cells(self.centres, probes)(F.col("v")))), "queries")
        blocks = settled(self.rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / LIST).cast("int").alias("row_blocks")).join(cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "cell"), "lists")
        tile = ["size", "query_block", "row_block"]
        asked = cells.join(blocks, "cell").select(F.col("cell").alias("size"), F.pmod(F.xxhash64("number"), F.col("blocks")).cast("int").alias("query_block"), F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)).alias("row_block"), F.lit(0).alias("is_row"), "number", "id", "v")
        lists = self.rows.join(blocks, "cell").select(F.col("cell").alias("size"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("query_block"), F.pmod(F.xxhash64("id", "v"), F.col("row_blocks")).cast("int").alias("row_block"), F.lit(1).alias("is_row"), F.lit(None).cast("long").alias("number"), "id", "v")
        met = asked.union(lists).repartition(*tile).sortWithinPartitions(*tile, "is_row").mapInArrow(best_of(k, places), "number long, id long, similarity double")
        rank = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("similarity"), "id"))
        best = met.withColumn("rank", rank).where(F.col("rank") <= k)
        return best.join(cells.select("number", F.col("id").alias("query_id")).distinct(), "number").select("query_id", "id", "similarity", "rank")


def _read(frame: DataFrame, id_col: str, vector_col: str, length: int | None = None) -> DataFrame:
    found = frame.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id IS NOT NULL AND size(v) > 0 AND NOT exists(v, x -> x IS NULL)")
    return found if length is None else found.where(F.size("v") == length)


def _cells(centres: np.ndarray, n: int):
    """The n nearest cells of each vector, nearest first."""

    @F.pandas_udf("array<int>")
    def cells(vectors: Iterator[pd.Series]) -> Iterator[pd.Series]:
        norms = (centres**2).sum(1)
        for batch in vectors:
            out = []
            for start in range(0, len(batch), 1024):
                v = np.stack(batch.iloc[start : start + 1024])
                out += list(np.argsort(norms[None, :] - 2 * v @ centres.T, axis=1, kind="stable")[:, :n].astype(np.int32))
            yield pd.Series(out)

    return cells


def build(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cells: int | None = None, sample: int = SAMPLE, seed: int = 7) -> VectorIndex:
    """An index of all rows whose vectors have the commonest length. The cells, by default about the root of the number of rows, are fitted by k-means on about `sample` of them; what is sent to tasks is at most CELLS vectors."""
    source = _read(rows, id_col, vector_col)
    lengths = source.groupBy(F.size("v").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), "length").first()
    if common is None:
        raise ValueError("no vectors to index")
    source = source.where(F.size("v") == common.length)
    cells = min(CELLS, cells or math.ceil(math.sqrt(common.n)), common.n)
    chosen = source if common.n <= sample else source.sample(sample / common.n, seed)
    chosen = chosen.select(array_to_vector("v").alias("features")).persist()
    # the row solver collects the distances between all centres in each round, with a task for each centre; the block solver collects only centres
    centres = np.array(KMeans(k=cells, seed=seed, maxIter=20, solver="block").fit(chosen).clusterCenters())
    chosen.unpersist()
    return VectorIndex(settled(source.withColumn("cell", F.element_at(_cells(centres, 1)(F.col("v")), 1)), "index"), centres)
