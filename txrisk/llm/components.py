"""Connected components of links that only Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.session import settle


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)``: the smallest id each id of ``links`` reaches.

    In a round each id takes the smallest label among its own and its neighbours', and then
    the label of that label, so the rounds grow with the logarithm of a chain.  A star of any size takes
    two rounds; sums per id are combined before the shuffle, and each round is a written table.
    """
    both = links.select(F.col(a).alias("src"), F.col(b).alias("dst")).where("src <> dst")
    both = settle(both.unionAll(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(), "links")
    labels = settle(both.groupBy(F.col("src").alias("id")).agg(F.least(F.col("id"), F.min("dst")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "dst"), "dst").groupBy(F.col("src").alias("id")).agg(F.min("component").alias("near"))
        least = labels.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("least"))
        jump = labels.select(F.col("id").alias("least"), F.col("component").alias("further"))
        new = least.join(jump, "least", "left").select("id", "old", F.least("least", "further").alias("component"))
        new = settle(new, "labels")
        labels = new.drop("old")
        if new.where("component <> old").isEmpty():
            return labels
