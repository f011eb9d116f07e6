"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.scratch import stage


def components(edges: DataFrame) -> DataFrame:
    """``a, b`` to ``node, component``: the smallest node reachable, for every node with an edge.

    Each round a node takes the smallest label of itself and its neighbours, then the label of that label, so that labels
    travel twice as far each time. Each round is a written table; nothing is gathered. Partial minima keep hubs cheap.
    """
    both = stage(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).filter("a <> b").distinct(), "component-edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")), "component-labels")
    while True:
        seen = (
            both.join(labels, both["b"] == labels["node"]).select(F.col("a").alias("node"), "component")
            .union(labels).groupBy("node").agg(F.min("component").alias("next"))
        )
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        # a label is always the id of a node with a label of its own
        stepped = stage(
            seen.join(jump, "next", "left").join(labels, "node")
            .select("node", F.least("next", F.coalesce("far", "next")).alias("component"), (F.least("next", F.coalesce("far", "next")) < F.col("component")).alias("moved")),
            "component-labels",
        )
        labels = stepped.select("node", "component")
        if stepped.filter("moved").limit(1).count() == 0:
            return labels
