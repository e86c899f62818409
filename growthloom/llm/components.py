"""Connected components of a graph too large for one task or the driver.

Minimum-label propagation with pointer jumping: each round hands every node
the least label among its neighbours, then follows the label one more step.
Rounds run on whole tables with partial aggregates (a node with a third of
all links is combined before the shuffle); each round's labels are written to
the shared folder, so a lost executor doesn't replay the rounds before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthloom.llm.common import scratch_table


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of ``edges``; label is the component's least node.

    Links to a null node, loops and repeated links count for nothing. No
    edges: an empty table.
    """
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x != y")
    links = scratch_table(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    labels = scratch_table(links.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("label")).withColumnRenamed("x", "node"), "labels")
    while True:
        near = (
            links.join(labels.withColumnRenamed("node", "y"), "y")
            .groupBy(F.col("x").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("far"))
        # A label is a node itself, so its own label is known.
        following = scratch_table(
            step.join(jump, "new").select("node", F.least("new", "far").alias("label"), (F.least("new", "far") != F.col("label")).alias("moved")),
            "labels",
        )
        labels = following.select("node", "label")
        if following.where("moved").isEmpty():
            return labels
