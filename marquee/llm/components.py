"""Connected components of a table of links, by smallest labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b: long); label is the smallest node that it reaches.

    Each round takes the smallest label next to a node, then the label of that label. Rounds are
    written, so a lost executor repeats one round at most. Links may repeat; no link is collected.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        ahead = labels.select(F.col("node").alias("label"), F.col("label").alias("ahead"))
        new = written(lower.join(ahead, "label").select("node", "old", F.least("label", "ahead").alias("label")), "labels")
        labels = new.select("node", "label")
        if new.where("label <> old").isEmpty():
            return labels
