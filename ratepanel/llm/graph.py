"""Connected components of an edge table, without gathering any component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratepanel.llm.frames import cut


def components(edges: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """`node, label`: the smallest node that each node of the edges `a, b` can reach.

    Each step takes the smallest label among a node's neighbours, then the label
    of its label, so paths shorten by half or more; labels are written out after
    each step. `start` may hold labels of a graph whose edges are all in this one.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node")
    if start is not None:
        old = start.select(F.col("node").alias("had"), F.col("label").alias("old"))
        labels = labels.join(old, labels.node == old.had, "left").select("node", F.coalesce(F.least("label", "old"), "label").alias("label"))
    labels = cut(labels)
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        seen = labels.join(near, labels.node == near.a).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        step = cut(seen)
        upper = step.select(F.col("node").alias("up"), F.col("label").alias("top"))
        # A label is always a node of the same component.
        jumped = cut(step.join(upper, step.label == upper.up).select("node", "old", F.col("top").alias("label")))
        changed = jumped.where(F.col("label") != F.col("old")).limit(1).count()
        labels = jumped.select("node", "label")
        if not changed:
            return labels
