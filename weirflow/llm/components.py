"""Connected components of links, by smallest label, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); label is the smallest node of its component.

    Each round takes the smallest label among a node's neighbours and then the
    label of that label, so what remains to go halves. A node with very many
    neighbours is a minimum per task before anything moves. Rounds are stored.
    """
    both = stored(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        heard = (
            both.join(labels.select(F.col("node").alias("a"), "label"), "a")
            .groupBy(F.col("b").alias("node"))
            .agg(F.min("label").alias("heard"))
        )
        lower = stored(
            labels.join(heard, "node").select("node", F.col("label").alias("was"), F.least("label", "heard").alias("label")),
            "labels",
        )
        above = lower.select(F.col("node").alias("label"), F.col("label").alias("above"))
        after = stored(lower.join(above, "label").select("node", "was", F.least("label", "above").alias("label")), "labels")
        labels = after.select("node", "label")
        if after.where("label <> was").isEmpty():
            return labels
