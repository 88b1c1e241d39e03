"""Graph operators over edge tables: triangles, ranks by links, reachability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.operators.settled import settled


def simple_edges(edges: DataFrame, a: str, b: str) -> DataFrame:
    """a < b: the undirected edges, each once, without loops and nulls."""
    return edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()


def triangles(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, degree, triangles: for each node of the undirected graph, of how many triangles it is a corner.

    Every edge points from its end of lesser degree to the other (ties: by node), so
    that no node points to more than the root of twice the number of edges, however
    many neighbours a hub has. The triangles over an edge are what the lists of its two
    ends have in common: no pair of neighbours is made.
    """
    pairs = settled(simple_edges(edges, a, b), "edges")
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degrees = settled(both.groupBy("a").agg(F.count(F.lit(1)).alias("degree")).withColumnRenamed("a", "node"), "degrees")
    of = lambda n: degrees.select(F.col("node").alias(n), F.col("degree").alias(f"d_{n}"))
    ends = pairs.join(of("a"), "a").join(of("b"), "b")
    first = F.struct("d_a", "a") < F.struct("d_b", "b")
    pointed = settled(ends.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("low"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("high")), "pointed")
    lists = settled(pointed.groupBy("low").agg(F.collect_list("high").alias("to")), "lists")
    met = pointed.join(lists.withColumnRenamed("to", "to_low"), "low").join(lists.select(F.col("low").alias("high"), F.col("to").alias("to_high")), "high")
    third = met.select("low", "high", F.array_intersect("to_low", "to_high").alias("third")).where(F.size("third") > 0)
    size = F.size("third").cast("long")
    corners = third.select(F.explode(F.concat(F.array(F.struct(F.col("low").alias("node"), size.alias("n")), F.struct(F.col("high").alias("node"), size.alias("n"))), F.transform("third", lambda w: F.struct(w.alias("node"), F.lit(1).cast("long").alias("n"))))).alias("c"))
    counts = corners.groupBy("c.node").agg(F.sum("c.n").alias("triangles"))
    return degrees.join(counts, "node", "left").select("node", "degree", F.coalesce("triangles", F.lit(0)).alias("triangles"))


def page_ranks(edges: DataFrame, source: str = "a", target: str = "b", damping: float = 0.85, rounds: int = 100, tolerance: float = 1e-9) -> DataFrame:
    """node, rank: PageRank of the directed multigraph; ranks sum to 1. What nodes without links hold is shared by all.

    Each round joins the ranks with the links by their source and sums by target, in
    the tasks first, and is written, so that lineage stays short. It ends after `rounds`
    or when the ranks change by less than `tolerance` in sum. Only three sums reach the
    driver.
    """
    links = settled(edges.select(F.col(source).alias("a"), F.col(target).alias("b")).dropna().groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), "links")
    outs = links.groupBy("a").agg(F.sum("n").alias("out"))
    links = settled(links.join(outs, "a").select("a", "b", (F.col("n") / F.col("out")).alias("share")), "shares")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    nodes = settled(nodes.join(outs.select(F.col("a").alias("node"), F.lit(True).alias("links")), "node", "left").select("node", F.col("links").isNull().alias("dangling")), "nodes")
    n = nodes.count()
    ranks = settled(nodes.select("node", "dangling", F.lit(1.0 / max(n, 1)).alias("rank")), "ranks")
    for _ in range(rounds if n else 0):
        kept = ranks.agg(F.sum(F.when(F.col("dangling"), F.col("rank")).otherwise(0.0)).alias("x")).first().x
        given = links.join(ranks.select(F.col("node").alias("a"), "rank"), "a").groupBy(F.col("b").alias("node")).agg(F.sum(F.col("rank") * F.col("share")).alias("given"))
        rank = F.lit((1 - damping) / n + damping * kept / n) + damping * F.coalesce("given", F.lit(0.0))
        ranks = settled(ranks.select("node", "dangling", F.col("rank").alias("was")).join(given, "node", "left").select("node", "dangling", rank.alias("rank"), "was"), "ranks")
        if ranks.agg(F.sum(F.abs(F.col("rank") - F.col("was"))).alias("x")).first().x < tolerance:
            break
    return ranks.select("node", "rank")


def reachable(edges: DataFrame, starts: DataFrame, steps: int, source: str = "a", target: str = "b") -> DataFrame:
    """node, hops: the nodes that `steps` links or fewer lead to from the nodes of `starts` (one column), with the least number of links. Each node goes on once, so circles end."""
    links = settled(edges.select(F.col(source).alias("a"), F.col(target).alias("b")).dropna().distinct(), "links")
    seen = settled(starts.toDF("node").dropna().distinct().withColumn("hops", F.lit(0)), "seen")
    found, last = seen, seen
    for hop in range(1, steps + 1):
        new = links.join(last.select(F.col("node").alias("a")), "a", "left_semi").select(F.col("b").alias("node")).distinct()
        last = settled(new.join(found, "node", "left_anti").withColumn("hops", F.lit(hop)), "seen")
        if last.isEmpty():
            break
        found = found.unionByName(last)
    return found
