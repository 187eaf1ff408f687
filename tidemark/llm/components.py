"""Connected components of a table of links, by the least label and shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node, root (the least node of its component) for every node of ``links`` (a, b).

    Each round takes the least label among a node's neighbours and then that label's own label, so chains shorten by
    halves. A hub is no group of one task: its neighbours are reduced to a minimum on the map side. Every round is written
    to the shared folder.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-links")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).select(F.col("a").alias("node"), "root"), name)
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        low = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("next"))
        up = labels.select(F.col("node").alias("next"), F.col("root").alias("above"))
        new = stored(low.join(up, "next").select("node", F.least("next", "above").alias("root"), (F.least("next", "above") != F.col("root")).alias("moved")), name)
        labels = new.select("node", "root")
        if new.where("moved").isEmpty():
            return labels
