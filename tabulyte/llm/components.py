"""Connected components of an edge table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabulyte.llm.scratch import kept


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b): label is the smallest node
    reachable.  Each round is a written table; rounds end when no label changes."""
    both = kept(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = kept(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        closer = labels.join(near, labels.node == near.a).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("next"))
        labels = kept(
            closer.join(jump, F.col("label") == F.col("at")).select("node", F.least("label", "next").alias("label"), "old"), "labels")
        if labels.filter("label < old").isEmpty():
            return labels.select("node", "label")
