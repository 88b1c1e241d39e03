"""Vector search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.operators.settled import settled
from quernstone.operators.vector_index import build
from quernstone.operators.vectors import nearest
from quernstone.plans.catalog import query
from quernstone.sources.tables import table


@query("""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
    p AS (SELECT q.vec_id AS query_id, r.vec_id AS id, round(list_inner_product(q.e, r.e), 6) AS similarity FROM v q JOIN v r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id)
    SELECT query_id, id, similarity, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS INT) AS rank FROM p QUALIFY rank <= 5""")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every twentieth vector."""
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where(F.col("vec_id") % 20 == 0), 5)


@query()
def indexed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every twentieth vector in the cells nearest to it, of an index of all rows; recall is the share of the exact ten that were found, over all queries."""
    rows = table(spark, sf_dir, "embeddings")
    queries = rows.where(F.col("vec_id") % 20 == 0)
    index = build(rows)
    found = index.nearest(queries, 10, max(1, len(index.centres) * 5 // 8))
    exact = nearest(rows, queries, 10).select("query_id", "id", F.lit(1).alias("hit"))
    # similarities that tie at the tenth place have one exact winner, the smaller id, in both searches
    both = settled(found.join(exact, ["query_id", "id"], "full"), "found")
    recall = both.agg((F.count_if(F.col("hit").isNotNull() & F.col("rank").isNotNull()) / F.sum("hit")).alias("recall")).first().recall
    return both.where("rank IS NOT NULL").select("query_id", "id", "similarity", "rank", F.lit(recall).alias("recall"))
