"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (id, component) for each id of ``edges`` (a, b); component is the smallest id reachable.

    Each round points every node at its smallest neighbour, follows the pointers to their
    roots, and contracts the edges to roots; at least half of the roots go in a round. All
    tables stay distributed; rounds are cut by written tables. No edges: no rows.
    """
    edges = scratch.save(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = scratch.save(edges.select("a").union(edges.select("b")).distinct().select(F.col("a").alias("id"), F.col("a").alias("component")))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("id", "to")
        parent = both.groupBy("id").agg(F.min("to").alias("to")).select("id", F.least("id", "to").alias("root"))
        parent = scratch.save(parent)
        while True:
            up = parent.select(F.col("id").alias("root"), F.col("root").alias("next"))
            jumped = scratch.save(parent.join(up, "root", "left").select("id", F.coalesce("next", "root").alias("root"), (F.coalesce("next", "root") != F.col("root")).alias("moved")))
            still = not jumped.where("moved").isEmpty()
            scratch.drop(parent)
            parent = jumped
            if not still:
                break
        root = parent.select("id", "root")
        new_labels = scratch.save(labels.join(root.withColumnRenamed("id", "component"), "component", "left").select("id", F.coalesce("root", "component").alias("component")))
        ends = edges.join(root.select(F.col("id").alias("a"), F.col("root").alias("ra")), "a").join(root.select(F.col("id").alias("b"), F.col("root").alias("rb")), "b")
        new_edges = scratch.save(ends.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        scratch.drop(labels, edges, parent)
        labels, edges = new_labels, new_edges
    return labels
