"""Connected components by joins; nothing is gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campusgrid.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component: smallest node reachable) for every node of an edge (a, b).

    Each round takes the smallest label among a node and its neighbours and then the
    label of that label, so long chains shrink fast. Every round is a written table.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.filter("a <> b").distinct())
    labels = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy(F.col("a").alias("n"))
            .agg(F.min("label").alias("near"))
        )
        nearer = labels.join(near, F.col("node") == F.col("n")).select(
            "node", F.least("label", "near").alias("label"), F.col("label").alias("old")
        )
        owner = labels.select(F.col("node").alias("owner"), F.col("label").alias("jump"))
        jumped = written(
            nearer.join(owner, F.col("label") == F.col("owner"), "left").select(
                "node", F.least("label", "jump").alias("label"), "old"
            )
        )
        labels = jumped.select("node", "label")
        if jumped.filter("label <> old").isEmpty():
            return labels.withColumnRenamed("label", "component")
