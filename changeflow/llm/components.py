"""Connected components of links, by labels that sink to the least node."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from changeflow.session import scratch_path, settle


def components(links: DataFrame) -> DataFrame:
    """`node` and `root`, the least node of its component, for every node of the links (`a`, `b`).

    Each round takes the least label of a node and its neighbours and then the label of that label, so
    the rounds grow with the logarithm of the longest path. A hub's links are reduced in each task
    before they are shuffled. Labels are written each round: nothing hangs on an earlier executor.
    """
    spark = links.sparkSession
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = settle(both.filter("a <> b").distinct(), scratch_path(spark, "links"))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root"))
    labels = settle(labels, scratch_path(spark, "labels"))
    while True:
        of_b = labels.select(F.col("node").alias("b"), F.col("root").alias("_near"))
        near = both.join(of_b, "b").groupBy(F.col("a").alias("node")).agg(F.min("_near").alias("_near"))
        sunk = labels.join(near, "node").select("node", F.col("root").alias("_old"), F.least("root", "_near").alias("_mid"))
        of_root = labels.select(F.col("node").alias("_mid"), F.col("root").alias("_far"))
        new = sunk.join(of_root, "_mid").select("node", "_old", F.least("_mid", "_far").alias("root"))
        seen = Observation()
        moved = F.count_if(F.col("root") < F.col("_old")).alias("moved")
        labels = settle(new, scratch_path(spark, "labels"), seen=seen, totals=[moved]).select("node", "root")
        if not seen.get["moved"]:
            return labels
