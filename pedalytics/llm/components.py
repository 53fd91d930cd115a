"""Connected components of a graph given as links, by repeated joins; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalytics.session import release, stage


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the smallest node reachable.

    Labels run along the links and then jump to the label of the label, so the number of rounds
    grows with the logarithm of the longest path. Each round is a written table.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
    edges = stage(both.where("a <> b").distinct(), "links")
    labels = stage(edges.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.least("label", "near").alias("to"), "label")
        step = stage(step, "labels")
        far = step.select(F.col("node").alias("to"), F.col("to").alias("far"))
        new = stage(step.join(far, "to").select("node", F.least("to", "far").alias("label"), F.col("label").alias("old")), "labels")
        release(labels, step)
        if new.where("label <> old").isEmpty():
            release(edges)
            return new.select("node", "label")
        labels = new
