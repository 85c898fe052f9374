"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def components(links: DataFrame) -> DataFrame:
    """(id, label): each linked node with the smallest id it can reach.

    ``links`` has columns a, b and is read once a round. Each round a node takes
    the smallest label of its neighbours and then the label of its label (pointer
    jumping), so the rounds grow with the logarithm of a chain's length. A round
    is one written table; only whether a label changed reaches the driver."""
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("label"))
    while True:
        near = (both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near")))
        hooked = (labels.join(near, labels["id"] == near["a"])
                  .select("id", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        top = hooked.select(F.col("id").alias("top"), F.col("label").alias("next"))
        jumped = written(hooked.join(top, F.col("label") == F.col("top"))
                         .select("id", "old", F.least("label", "next").alias("label")), "labels")
        labels = jumped.select("id", "label")
        if not jumped.where("label != old").limit(1).count():
            return labels
