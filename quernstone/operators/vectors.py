"""Exact nearest vectors of a stated query set."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernstone.operators.settled import settled

#: Queries of a block, which a task holds at a time: 4,096 vectors of 1,024 doubles are 32 MB.
BLOCK = 4096


def best_of(k: int, places: int):
    """The k best rows for each query of a tile; its queries come first, then its rows, of which a batch at a time is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, queries, best, found = None, [], None, None

        def done() -> Iterator[pa.RecordBatch]:
            if found is not None:
                kept = np.isfinite(best)
                numbers = np.array([n for n, _, _ in queries], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(numbers, kept.sum(1))), pa.array(found[kept]), pa.array(best[kept])], names=["number", "id", "similarity"])

        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("size", "query_block", "row_block", "is_row")]
            tiles = np.stack(columns, 1)
            borders = np.concatenate(([0], np.flatnonzero((tiles[1:] != tiles[:-1]).any(1)) + 1, [len(tiles)])).tolist()
            for i, j in zip(borders, borders[1:]):
                if i == j:
                    continue
                *tile, is_row = tiles[i].tolist()
                if tile != key:
                    yield from done()
                    key, queries, best, found = tile, [], None, None
                part = batch.slice(i, j - i)
                ids, vectors = part.column("id").to_numpy(), part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(j - i, -1)
                if not is_row:
                    queries += zip(part.column("number").to_pylist(), ids.tolist(), vectors)
                elif queries:
                    if best is None:
                        best, found = np.full((len(queries), k), -np.inf), np.full((len(queries), k), -1, np.int64)
                        asked, targets = np.array([x for _, x, _ in queries]), np.stack([v for _, _, v in queries])
                    for start in range(0, len(ids), 1024):
                        own = ids[start : start + 1024]
                        likeness = np.round(targets @ vectors[start : start + 1024].T, places)
                        likeness[asked[:, None] == own[None, :]] = -np.inf
                        both, names = np.concatenate((best, likeness), 1), np.concatenate((found, np.repeat(own[None, :], len(asked), 0)), 1)
                        order = np.lexsort((names, -both), axis=1)[:, :k]
                        best, found = np.take_along_axis(both, order, 1), np.take_along_axis(names, order, 1)
        yield from done()

    return run


def nearest(rows: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", places: int = 6, block: int = BLOCK, parts: int | None = None) -> DataFrame:
    """query_id, id, similarity, rank: the k rows with the largest inner product with each query, rows of its own id left out.

    A query meets the rows whose vector is as long as its own. Queries and rows are
    dealt into blocks; each block of queries and block of rows meet in one task, which
    keeps the k best of its rows for each query. So no pair is stored, nothing passes
    through the driver, and a query sends k rows for each block of rows. Similarities
    are rounded to `places`; ties go to the smaller id; a query that is there twice is
    answered twice. Null ids, null or empty vectors, and pairs whose
    product is not finite are left out.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = lambda f: f.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id IS NOT NULL AND size(v) > 0 AND NOT exists(v, x -> x IS NULL)")
    wanted = settled(read(queries).withColumns({"number": F.monotonically_increasing_id(), "size": F.size("v")}), "queries")
    blocks = wanted.groupBy("size").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    asked = wanted.join(blocks, "size").select("size", F.pmod(F.xxhash64("number"), F.col("blocks")).cast("int").alias("query_block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("row_block"), F.lit(0).alias("is_row"), "number", "id", "v")
    found = read(rows).withColumn("size", F.size("v")).join(blocks, "size")
    found = found.select("size", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("query_block"), F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int").alias("row_block"), F.lit(1).alias("is_row"), F.lit(None).cast("long").alias("number"), "id", "v")
    tile = ["size", "query_block", "row_block"]
    met = asked.union(found).repartition(*tile).sortWithinPartitions(*tile, "is_row").mapInArrow(best_of(k, places), "number long, id long, similarity double")
    rank = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("similarity"), "id"))
    best = met.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.join(wanted.select("number", F.col("id").alias("query_id")), "number").select("query_id", "id", "similarity", "rank")
