"""Connected components of a graph of any size, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textsignal.llm.store import stored


def components(edges: DataFrame) -> DataFrame:
    """Rows (`node`, `component`): the least node reachable from each node of the edges (a, b).

    Every round takes the least label among a node and its neighbours, and then the label of that
    label, so that paths shorten by more than half. Labels are written after each round; only the
    number of changes reaches the driver. A node without edges has no row.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = stored(both.where(F.col("a") != F.col("b")).distinct())
    labels = stored(
        links.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.first("a")).alias("component")
        )
    )
    while True:
        of = labels.select(F.col("node").alias("b"), "component")
        near = links.join(of, "b").groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("_near")
        )
        better = stored(
            labels.join(near, "node").select(
                "node",
                F.least("component", "_near").alias("_new"),
                F.col("component").alias("_old"),
            )
        )
        jump = better.select(F.col("node").alias("_new"), F.col("_new").alias("_far"))
        after = stored(
            better.join(jump, "_new").select(
                "node", F.least("_new", "_far").alias("component"), "_old"
            )
        )
        labels = after.drop("_old")
        if after.where(F.col("component") != F.col("_old")).isEmpty():
            return labels
