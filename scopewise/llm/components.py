"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scopewise.session import discard, materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from every node of ``edges`` (a, b).

    Every round takes the smallest label among a node and its neighbours and then the label of that
    label, so that long paths halve. Labels are stored after each round; the loop ends with the first
    round that changes none.
    """
    both = materialize(
        edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges"
    )
    labels = materialize(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels"
    )
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(seen, labels["node"] == seen["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        target = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        jumped = nearer.join(target, "label").select("node", "old", F.least("label", "further").alias("label"))
        stored = materialize(jumped, "labels")
        discard(labels)
        if stored.where("old <> label").isEmpty():
            discard(both)
            return stored.select("node", F.col("label").alias("component"))
        labels = stored
