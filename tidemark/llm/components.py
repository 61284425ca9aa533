"""Connected components of a graph held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``edges`` (a, b): the smallest node it is connected with.

    Each round takes the smallest label of the neighbours, then the label of that label,
    so labels travel further every round.  Labels are written to the shared folder between
    rounds.  A node with many neighbours gets one row from each task.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component")), "labels")
    while True:
        heard = (both.join(labels.toDF("b", "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("label")))
        nearer = labels.join(heard, "node").select("node", "component", F.least("component", "label").alias("label"))
        further = labels.toDF("label", "next")
        new = stored(nearer.join(further, "label").select("node", F.col("component").alias("old"), F.col("next").alias("component")), "labels")
        moved = not new.where("old <> component").isEmpty()
        labels = new.drop("old")
        if not moved:
            return labels
