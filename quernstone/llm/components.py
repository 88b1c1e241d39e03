"""Connected components of links, by rounds of DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import discard, settle


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id that each linked id reaches.

    Each round gives every id the least label among itself and its neighbours,
    then the label of that label (pointer jumping), until nothing changes. A
    round is written to the shared folder, so lineage stays short.
    """
    ab = links.select(F.col(a).alias("id"), F.col(b).alias("other"))
    edges = settle(ab.union(ab.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct(), "edges")
    labels = settle(edges.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("component")), "labels")
    while True:
        near = edges.join(labels.withColumnsRenamed({"id": "other"}), "other").groupBy("id").agg(F.min("component").alias("near"))
        lowered = labels.join(near, "id").select("id", "component", F.least("component", "near").alias("least"))
        root = labels.select(F.col("id").alias("least"), F.col("component").alias("root"))
        changed = settle(lowered.join(root, "least", "left").select("id", F.col("component").alias("was"), F.least("least", F.coalesce("root", "least")).alias("component")), "labels")
        discard(labels)
        labels = changed.select("id", "component")
        labels.settled_at = changed.settled_at
        if changed.where(F.col("was") != F.col("component")).isEmpty():
            discard(edges)
            return labels
