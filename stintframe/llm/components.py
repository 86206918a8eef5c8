"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for all nodes of ``links`` (a, b); the root is the smallest node reachable.

    Each step every node takes the smallest root among its neighbours, then the
    root of its root, so paths halve. Labels are written each step; the loop ends
    when no label changed.
    """
    both = stored(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
            "node", F.least("node", "low").alias("root")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        low = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("root").alias("further"))
        moved = stored(
            low.join(jump, "low").select("node", "old", F.least("low", "further").alias("root")), "labels"
        )
        labels = moved.select("node", "root")
        if moved.where("root <> old").isEmpty():
            return labels
