"""Connected components of a graph of links, by hooking to the smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written


def components(links: DataFrame) -> DataFrame:
    """links: a, b (long). Each node with the smallest node of its component: node, root. Every round takes the
    smallest label among a node's neighbours and then that label's own label, until no label changes; rounds are
    written, so lineage stays short and a lost executor costs one round at most. No links: no rows."""
    both = links.where("a <> b").select("a", "b")
    both = written(both.union(both.select("b", "a")).toDF("node", "other").distinct(), "links")
    labels, before = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")), None
    while True:
        labels = written(labels, "labels")
        if before is not None:
            dropped(before)
        of = labels.select(F.col("node").alias("other"), F.col("root").alias("other_root"))
        best = both.join(of, "other").groupBy("node").agg(F.min("other_root").alias("near"))
        hooked = labels.join(best, "node").select("node", "root", F.least("root", "near").alias("hook"))
        up = labels.select(F.col("node").alias("hook"), F.col("root").alias("up"))
        moved = written(hooked.join(up, "hook").select("node", F.col("root").alias("was"), F.least("hook", "up").alias("root")), "moved")
        dropped(labels)
        labels, before = moved.select("node", "root"), moved
        if moved.where("was <> root").isEmpty():
            dropped(both)
            return labels
