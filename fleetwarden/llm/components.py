"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwarden.session import staged


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of links (x, y); the label is the component's smallest node.

    Each round a node takes the smallest label among its neighbours, and then the label of that label, until nothing
    changes. Every round is written to the shared folder, so lineage stays short, and only a count comes back.
    A link table without rows gives a table without rows.
    """
    edges = staged(links.select("x", "y").union(links.select("y", "x")).where("x <> y").distinct().toDF("x", "y"))
    labels = staged(edges.groupBy(F.col("x").alias("node")).agg(F.least(F.min("x"), F.min("y")).alias("label")))
    while True:
        near = (
            edges.join(labels.withColumnsRenamed({"node": "y"}), "y")
            .groupBy(F.col("x").alias("node"))
            .agg(F.min("label").alias("seen"))
        )
        lower = labels.join(near, "node", "left").select(
            "node", F.col("label").alias("was"), F.least("label", F.coalesce("seen", "label")).alias("label")
        )
        lower = staged(lower)
        jump = lower.select(F.col("node").alias("at"), F.col("label").alias("next"))
        new = staged(
            lower.join(jump, F.col("label") == F.col("at"), "left").select(
                "node", "was", F.coalesce("next", "label").alias("label")
            )
        )
        changed = new.where("was <> label").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
