"""Connected components over links, by spreading the smallest id, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualitymart.llm.common import only_last, stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a, b``): the smallest id reachable.

    Each round takes the smallest label among a node's neighbours and then the label of that label, so paths
    shorten by half or more. Labels are written after each round; only the number of changes is collected.
    """
    return only_last(links.sparkSession, lambda: spread(links))


def spread(links: DataFrame) -> DataFrame:
    edges = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(edges.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("node"), F.least("a", "_m").alias("component")), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("_near"))
        least = labels.join(near, labels["node"] == near["a"]).select("node", F.col("component").alias("_old"), F.least("component", "_near").alias("_new"))
        heads = labels.select(F.col("node").alias("_head"), F.col("component").alias("_far"))
        jumped = least.join(heads, F.col("_new") == F.col("_head"), "left")
        after = stored(jumped.select("node", "_old", F.least("_new", F.coalesce("_far", "_new")).alias("component")), "labels")
        labels = after.select("node", "component")
        if not after.where("component <> _old").limit(1).count():
            return labels
