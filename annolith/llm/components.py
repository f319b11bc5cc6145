"""Connected components of a link table, by label passing with pointer jumping; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolith.session import discard, kept


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``links(a, b)`` to ``(v, label)``: the smallest vertex reachable, for each vertex that has a link.

    Every round each vertex takes the smallest label around it, then the label of its label; paths shorten by half or more.
    Partial aggregation keeps a vertex with many links from gathering them in one task.
    """
    both = kept(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = kept(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("label")), "labels")
    for _ in range(most_rounds):
        around = both.join(labels.withColumnRenamed("v", "b"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        lower = labels.join(around, "v").select("v", F.least("label", "near").alias("low"), F.col("label").alias("old"))
        lower = kept(lower, "lower")
        target = lower.select(F.col("v").alias("low"), F.col("low").alias("lowest"))
        jumped = kept(lower.join(target, "low").select("v", F.least("low", "lowest").alias("label"), "old"), "labels")
        discard(lower, labels)
        labels = jumped
        if labels.where("label <> old").isEmpty():
            discard(both)
            return labels  # the caller may discard it
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
