"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.session import stage


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the root is the smallest node reachable.

    Each round, a node takes the smallest label among its neighbours' and its own, then the
    label of its label, so labels travel over doubling distances. Neighbours'
    labels are joined and reduced before they are shuffled, so a node with very many links costs
    no single task. Every round's labels are written to the shared folder. Nulls in ``a`` or ``b`` are no links;
    without links there are no rows.
    """
    edges = links.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select("a", "b")
    both = stage(edges.union(edges.select("b", "a")).distinct(), "links")
    labels = stage(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("root")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("root").alias("near"))
        own = labels.join(near, labels.node == near.a).select(
            "node", F.col("root").alias("before"), F.least("root", "near").alias("root")
        )
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        moved = own.join(jump, "root").select("node", "before", F.least("root", "far").alias("root"))
        labels = stage(moved, "labels")
        if labels.where("before <> root").isEmpty():
            return labels.select("node", "root")
