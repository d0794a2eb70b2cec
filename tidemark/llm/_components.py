"""Connected components of an edge table, by hooking to the smallest neighbour and pointer jumping.

Every round at least halves the roots that still have edges, and no link,
label or component ever reaches the driver: only counts do.  Rounds read and
write tables in the shared checkpoint folder, so a lost executor costs the
tasks it ran; joins are between plainly exchanged tables, which lets AQE split
a hot label, and minima are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ._stage import stage


def _flat(parents: DataFrame) -> DataFrame:
    """(node, parent) with every parent a root."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        jumped = stage(parents.join(up, "parent", "left").select("node", F.coalesce("grand", "parent").alias("parent"), (F.col("grand") != F.col("parent")).alias("moved")), "jump")
        if jumped.filter("moved").limit(1).count() == 0:
            return jumped.select("node", "parent")
        parents = jumped.select("node", "parent")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: long): label is the smallest node of the component."""
    left = stage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    labels = None
    while left.limit(1).count():
        ends = left.select(F.col("b").alias("node"), F.col("a").alias("parent")).unionByName(left.select(F.col("a").alias("node"), F.col("a").alias("parent"))).unionByName(
            left.select(F.col("a").alias("node"), F.col("b").alias("parent")))
        # unconditional hooks go down only: a root hooks to its smallest neighbour or stays
        parents = _flat(stage(ends.groupBy("node").agg(F.min("parent").alias("parent")).select("node", F.least("node", "parent").alias("parent")), "hook"))
        if labels is None:
            labels = parents.withColumnRenamed("parent", "label")
        else:
            moved = parents.select(F.col("node").alias("label"), "parent")
            labels = stage(labels.join(moved, "label", "left").select("node", F.coalesce("parent", "label").alias("label")), "labels")
        a, b = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa")), parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        left = stage(left.join(a, "a").join(b, "b").filter("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    return labels if labels is not None else left.select(F.col("a").alias("node"), F.col("b").alias("label"))
