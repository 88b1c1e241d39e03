"""Graph queries: parts that follow each other in orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quernstone.operators.graphs import page_ranks, reachable, triangles
from quernstone.plans.catalog import query
from quernstone.sources.tables import table

#: A link from each item's part to the part of the order's next item.
LINKS = """
    links AS (SELECT l_partkey AS a, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS b FROM lineitem),
    pairs AS (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM links WHERE b IS NOT NULL AND a <> b)"""


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    after = F.lead("l_partkey").over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("a"), after.alias("b"))


@query(f"""
    WITH {LINKS}, t AS (SELECT x.a AS u, x.b AS v, y.b AS w FROM pairs x JOIN pairs y ON x.b = y.a JOIN pairs z ON z.a = x.a AND z.b = y.b),
    n AS (SELECT node, count(*) AS triangles FROM (SELECT u AS node FROM t UNION ALL SELECT v FROM t UNION ALL SELECT w FROM t) GROUP BY node),
    d AS (SELECT node, count(*) AS degree FROM (SELECT a AS node FROM pairs UNION ALL SELECT b FROM pairs) GROUP BY node)
    SELECT d.node, d.degree, CAST(coalesce(n.triangles, 0) AS BIGINT) AS triangles FROM d LEFT JOIN n ON d.node = n.node""")
def part_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triangles(_links(spark, sf_dir))


@query(f"""
    WITH RECURSIVE {LINKS}, walk AS (SELECT CAST(7 AS BIGINT) AS node, 0 AS hops UNION SELECT links.b, hops + 1 FROM walk JOIN links ON links.a = walk.node WHERE links.b IS NOT NULL AND hops < 3)
    SELECT node, min(hops) AS hops FROM walk GROUP BY node""")
def reachable_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that follow part 7 by at most three links."""
    return reachable(_links(spark, sf_dir), spark.range(7, 8), 3)


@query()
def part_ranks_by_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PageRank of the parts; no SQL, since it is a fixed point, but a test against powers of the matrix."""
    return page_ranks(_links(spark, sf_dir), rounds=30, tolerance=1e-7)
