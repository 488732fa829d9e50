"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.shared import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable over edges (a, b); only nodes with an edge.

    Every round takes the least label among neighbours, then the label of that label; each is cut
    off by a staged table. Stars end after two rounds, long chains after about the logarithm of
    their length. Sums and minima are combined before the shuffle, so a hub sends one row per task.
    """
    both = staged(
        edges.select("a", "b").where("a <> b").union(edges.where("a <> b").select("b", "a"))
        .toDF("node", "other").distinct(), "edges",
    )
    labels = staged(
        both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("component")), "labels"
    )
    while True:
        near = (
            both.join(labels.toDF("other", "theirs"), "other").groupBy("node")
            .agg(F.min("theirs").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("component")
        )
        jump = labels.toDF("component", "beyond")
        stepped = staged(
            lower.join(jump, "component", "left").select(
                "node", "before", F.coalesce("beyond", "component").alias("component")
            ), "labels",
        )
        labels = stepped.select("node", "component")
        if stepped.where("component <> before").limit(1).count() == 0:
            return labels
