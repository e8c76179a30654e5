"""Running totals over a whole table in order, without one task that sees every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.session import settle


def running_totals(df: DataFrame, by: Sequence[str], order: Column, sums: Sequence[str]) -> DataFrame:
    """Add ``<sum>_upto``: the running total of each column of ``sums`` in ``order`` per ``by``.

    ``df`` should have one row per ``(by, order)``.  It is range-partitioned and
    written once, so the part a row lies in is a fixed fact.  A part adds its own
    running total to what the parts before it hold; the table of part totals has one
    row per partition and ``by`` group that meets in it.
    """
    parts = (
        df.withColumn("_order", order)
        .repartitionByRange(*by, "_order")
        .sortWithinPartitions(*by, "_order")
        .withColumn("_part", F.spark_partition_id())
    )
    parts = settle(parts, "ordered")
    totals = parts.groupBy(*by, "_part").agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "_part", *[F.coalesce(F.sum(f"_{s}").over(before), F.lit(0)).alias(f"_{s}") for s in sums])
    within = Window.partitionBy(*by, "_part").orderBy("_order").rowsBetween(Window.unboundedPreceding, 0)
    return (
        parts.join(offsets, [*by, "_part"])
        .withColumns({f"{s}_upto": F.col(f"_{s}") + F.sum(s).over(within) for s in sums})
        .drop("_order", "_part", *[f"_{s}" for s in sums])
    )
