"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is named by its smallest node.

    Each pass takes the least label among the neighbours, then the label of
    that label, so chains shorten by halves. Passes end when no label changes.
    Labels are written between passes.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.filter("a != b").distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        near = near.agg(F.min("component").alias("near"))
        stepped = labels.join(near, "node", "left")
        stepped = stepped.select(
            "node", F.col("component").alias("was"), F.least("component", F.coalesce("near", "component")).alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("component").alias("beyond"))
        after = stepped.join(jump, "label", "left").select(
            "node", "was", F.least("label", F.coalesce("beyond", "label")).alias("component")
        )
        after = stored(after, "labels")
        labels = after.select("node", "component")
        if after.filter("was != component").isEmpty():
            return labels
