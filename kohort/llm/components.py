"""Connected components of a link table, with Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_table


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component: its smallest node.

    Each round every node takes the smallest label next to it and then the
    label of its label, so the rounds grow with the logarithm of the longest
    path.  Labels are written to the shared folder after each round.  A node
    with very many links costs map-side minima and joins that the adaptive
    skew join can split.
    """
    both = links.where("a <> b").select("a", "b")
    both = shared_table(both.union(both.select("b", "a")).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    labels = shared_table(labels.select("node", F.least("node", "near").alias("component")), "labels")
    while True:
        seen = (both.join(labels, both["b"] == labels["node"])
                .groupBy("a").agg(F.min("component").alias("near")))
        stepped = labels.join(seen, labels["node"] == seen["a"]).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        root = labels.select(F.col("node").alias("r"), F.col("component").alias("rc"))
        jumped = stepped.join(root, stepped["component"] == root["r"], "left").select(
            "node", "old", F.least("component", F.coalesce("rc", "component")).alias("component"))
        done = shared_table(jumped, "labels")
        labels = done.select("node", "component")
        if done.where("old <> component").isEmpty():
            return labels
