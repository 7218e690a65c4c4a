"""Connected components of a written edge table: smallest label, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): label is the component's smallest node.

    Each round gives a node the smallest label among its neighbours and then the label of that
    label, so chains shorten by half or more. Rounds are written tables; only the number of
    changed labels comes to the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).filter("a <> b").distinct()
    both = written(both, "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node", "left").select("node", "label", F.least("label", F.coalesce("near", "label")).alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        moved = lower.join(jump, "low", "left").select("node", "label", F.least("low", F.coalesce("far", "low")).alias("next"))
        moved = written(moved, "labels")
        labels = moved.select("node", F.col("next").alias("label"))
        if not moved.filter("label <> next").take(1):
            return labels
