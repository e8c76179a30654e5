"""Sampling, splitting and class balancing that give the same rows on any layout."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions import hash_bucket, hash_order
from txrisk.operators.ordered import running_totals
from txrisk.schema import LABEL

#: hash fractions are told to 60 bits, so a share of any table has its rows
BUCKETS = 1 << 60


def random_rows(df: DataFrame, k: int, seed: int, key: str) -> DataFrame:
    """``k`` random rows, a top-k by seeded hash of ``key``: one scan and no full sort."""
    return df.orderBy(hash_order(key, seed), key).limit(k)


def sample(df: DataFrame, fraction: float, seed: int, key: str | None = None) -> DataFrame:
    """A share of the rows.

    With ``key`` a row is in or out by the hash of its key, whatever the
    partitioning; without, Spark draws per partition.
    """
    if key is None:
        return df.sample(fraction=fraction, seed=seed)
    return df.filter(hash_bucket(key, seed, BUCKETS) < round(fraction * BUCKETS))


def split(df: DataFrame, weights: Sequence[float], seed: int, key: str | None = None) -> list[DataFrame]:
    """Disjoint parts in proportion to ``weights``, which must add up to 1.

    With ``key`` all rows of a key (copies made by oversampling, say) share a part.
    """
    if abs(sum(weights) - 1) > 1e-9:
        raise ValueError(f"weights must add up to 1, not {sum(weights)}")
    if key is None:
        return df.randomSplit(list(weights), seed)
    ends = [round(w * BUCKETS) for w in accumulate(weights)]
    ends[-1] = BUCKETS
    bucket = hash_bucket(key, seed, BUCKETS)
    return [df.filter((bucket >= low) & (bucket < high)) for low, high in zip([0, *ends], ends)]


def folds(df: DataFrame, n: int, seed: int | str, key: str, output: str = "fold") -> DataFrame:
    """Add a fold ``0 .. n-1`` by the hash of ``key``: the same on any layout, and copies of a row share one."""
    return df.withColumn(output, (hash_bucket(key, seed, BUCKETS) % n).cast("int"))


def numbered(df: DataFrame, seed: int | str, key: str, output: str = "index") -> DataFrame:
    """Add ``0 .. rows-1`` in a seeded random order of the unique ``key``; no task sees all rows."""
    order = F.concat(hash_order(key, seed), F.lit("|"), F.col(key).cast("string"))
    counted = running_totals(df.withColumn("_one", F.lit(1).cast("long")), [], order, ["_one"])
    return counted.withColumn(output, F.col("_one_upto") - 1).drop("_one", "_one_upto")


def class_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    """One row ``(n0, n1)``: rows of either class, in one pass."""
    return df.agg(
        F.count_if(F.col(label) == 0).alias("n0"),
        F.count_if(F.col(label) == 1).alias("n1"),
    )


def class_ratio(df: DataFrame, label: str = LABEL, strict: bool = False) -> DataFrame:
    """One row ``(n0, n1, factor)`` with ``factor = floor(n0 / n1)``.

    The factor is at least 1, also when there are no positives.  ``strict`` keeps
    the plain quotient: 0 when positives outnumber negatives, NULL when there are none.
    """
    quotient = F.floor(F.try_divide("n0", "n1")).cast("int")
    factor = quotient if strict else F.greatest(F.lit(1), F.coalesce(quotient, F.lit(1)))
    return class_counts(df, label).withColumn("factor", factor)


def replicate(df: DataFrame, k: int | Column) -> DataFrame:
    """``k`` copies of each row; none for ``k = 0``."""
    k = F.lit(k) if isinstance(k, int) else k
    return df.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), k.cast("int")))).drop("_copy")


def oversample(df: DataFrame, label: str = LABEL, strict: bool = False) -> DataFrame:
    """Repeat positive rows until the classes are about even.

    Copies are made where the row lies, so nothing is shuffled; the factor is a
    scalar subquery, so ``df`` is read once for it and once for the rows.
    """
    undefined = F.raise_error(F.lit("no positive rows")).cast("int")
    factor = class_ratio(df, label, strict).select(F.coalesce("factor", undefined)).scalar()
    positive = F.when(F.col(label) == 1, factor).when(F.col(label) == 0, 1).otherwise(0)
    return replicate(df, positive)
