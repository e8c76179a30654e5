"""k-anonymity: quasi-identifiers give way to ranges that at least k rows share."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.session import settle

#: a table of cuts of at most so many groups is broadcast
MOST_BROADCAST = 100_000
#: rank error of a median is the rows of a group divided by this
ACCURACY = 10_000
#: a group of at most so many rows is cut to its end in one task, and tasks for this at most
TASK_ROWS = 50_000
MOST_TASKS = 100_000


def _whole(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns])


def _fields(columns: Sequence[str], *prefixes: str) -> list[str]:
    return [f"{p}{i}" for p in prefixes for i in range(len(columns))]


def _cuts(rows: DataFrame, columns: Sequence[str], k: int, spans: Sequence[float], accuracy: int) -> DataFrame:
    """``(group, column, at, strict, low, high)`` of each group that can be cut; the last two are the rows on either side.

    One aggregation finds ranges and medians of all groups, one counts what lies on either side of the medians.  Both combine
    before the shuffle and a median is a digest of bounded size, so a group may hold the whole table.
    """
    indexed = list(enumerate(columns))
    found = rows.groupBy("group").agg(
        F.count(F.lit(1)).alias("size"),
        *[F.percentile_approx(c, 0.5, accuracy).alias(f"m{i}") for i, c in indexed],
        *[(F.max(c) - F.min(c)).cast("double").alias(f"w{i}") for i, c in indexed],
    )
    found = settle(found.where(F.col("size") >= 2 * k), "medians")
    sides = join_groups(rows, found, "inner").groupBy("group").agg(
        F.first("size").alias("size"),
        *[F.first(f).alias(f) for f in _fields(columns, "m", "w")],
        *[F.count_if(F.col(c) <= F.col(f"m{i}")).alias(f"le{i}") for i, c in indexed],
        *[F.count_if(F.col(c) < F.col(f"m{i}")).alias(f"lt{i}") for i, c in indexed],
    )

    def enough(count: str) -> Column:
        return (F.col(count) >= k) & (F.col("size") - F.col(count) >= k)

    # the widest column that leaves k rows on both sides; the median goes to the low side where it can
    choices = F.array(*[
        F.struct((F.col(f"w{i}") / F.lit(spans[i] or 1.0)).alias("width"), F.lit(-i).alias("order"), F.lit(i).alias("column"),
                 F.col(f"m{i}").cast("double").alias("at"), (~enough(f"le{i}")).alias("strict"), (enough(f"le{i}") | enough(f"lt{i}")).alias("good"),
                 F.when(enough(f"le{i}"), F.col(f"le{i}")).otherwise(F.col(f"lt{i}")).alias("low"))
        for i, _ in indexed
    ])
    best = F.array_max(F.filter(choices, lambda x: x["good"]))
    cuts = sides.select("group", "size", best.alias("best")).where("best IS NOT NULL")
    return settle(cuts.select("group", "best.column", "best.at", "best.strict", "best.low", (F.col("size") - F.col("best.low")).alias("high")), "cuts")


def join_groups(rows: DataFrame, groups: DataFrame, how: str) -> DataFrame:
    """Join a table with one row per group: broadcast where a count shows that it is small, else a shuffle that AQE splits where a group is large."""
    return rows.join(F.broadcast(groups) if groups.count() <= MOST_BROADCAST else groups, "group", how)


def _leaves(values: Sequence[np.ndarray], k: int, spans: Sequence[float]) -> list[np.ndarray]:
    """The rows of each group that the cuts of :func:`_cuts` leave, for a group that one task holds."""
    leaves, open_ = [], [np.arange(len(values[0]))]
    while open_:
        at = open_.pop()
        middle, choices = (len(at) - 1) // 2, []
        for i, column in enumerate(values if len(at) >= 2 * k else ()):
            v = column[at]
            median = np.partition(v, middle)[middle]
            le, lt = np.count_nonzero(v <= median), np.count_nonzero(v < median)
            strict = not (le >= k and len(at) - le >= k)
            if not strict or (lt >= k and len(at) - lt >= k):
                with np.errstate(invalid="ignore"):
                    width = float(v.max() - v.min()) / (spans[i] or 1.0)
                choices.append((np.isnan(width), width, -i, float(median), strict))
        if not choices:
            leaves.append(at)
            continue
        _, _, i, median, strict = max(choices, key=lambda c: (c[0], 0.0 if c[0] else c[1], c[2]))
        value = values[-i][at].astype(float)
        low = value < median if strict else value <= median
        open_ += [at[low], at[~low]]
    return leaves


def _finished(rows: DataFrame, columns: Sequence[str], k: int, spans: Sequence[float], tasks: int) -> DataFrame:
    """What :func:`groups_of` gives, for groups of at most ``TASK_ROWS`` rows."""
    out = T.StructType(
        [rows.schema[c] for c in columns]
        + [T.StructField(f"{c}_{end}", rows.schema[c].dataType) for c in columns for end in ("low", "high")]
        + [T.StructField("group_size", T.LongType())]
    )

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        values = [group[c].to_numpy() for c in columns]
        numbers = [v.astype(float) if v.dtype == object else v for v in values]
        leaves = _leaves(numbers, k, spans)
        of = np.empty(len(group), np.int64)
        for number, at in enumerate(leaves):
            of[at] = number
        found = {c: values[i] for i, c in enumerate(columns)}
        for i, c in enumerate(columns):
            for end, furthest in (("low", np.argmin), ("high", np.argmax)):
                found[f"{c}_{end}"] = values[i][np.array([at[furthest(numbers[i][at])] for at in leaves])[of]]
        found["group_size"] = np.array([len(at) for at in leaves])[of]
        return pd.DataFrame(found)[out.names].drop_duplicates(list(columns))

    return rows.select(*columns, "group").repartition(tasks, "group").groupBy("group").applyInPandas(finish, out)


def groups_of(df: DataFrame, columns: Sequence[str], k: int, accuracy: int = ACCURACY) -> DataFrame:
    """``(*columns, <column>_low, <column>_high, group_size)`` for each combination of values, by recursive median cuts.

    Numeric columns only.  All large groups are cut in the same round; one that no median can cut into parts of ``k`` rows is
    closed and takes no part in later rounds.  A group small enough for a task (``TASK_ROWS``, and few enough rows for exact medians by ``accuracy``) is
    cut to its end there, by the same rule, so there are about log2(rows / TASK_ROWS) rounds, each over large groups alone, and one shuffle of all rows.
    """
    columns = list(columns)
    narrow = df.select(*columns).where(_whole(columns))
    ends = narrow.agg(*[(F.max(c) - F.min(c)).cast("double").alias(f"w{i}") for i, c in enumerate(columns)], F.count(F.lit(1)).alias("n")).first()
    spans = [ends[f"w{i}"] for i in range(len(columns))]
    most = min(TASK_ROWS, (accuracy - 1) // 2)
    whole = narrow.withColumn("group", F.lit(""))
    if ends["n"] <= most:
        return settle(_finished(whole if ends["n"] >= k else whole.limit(0), columns, k, spans, 1), "finished")
    rows, groups, small, closed = settle(whole, "open"), 1, [], []
    while groups:
        cuts = _cuts(rows, columns, k, spans, accuracy)
        met = join_groups(rows, cuts, "left")
        large = [F.coalesce(F.sum((F.col(side) > most).cast("long")), F.lit(0)) for side in ("low", "high")]
        made = cuts.agg(F.count(F.lit(1)).alias("cut"), (large[0] + large[1]).alias("large")).first()
        if made["cut"] < groups:
            closed.append(met.where(F.col("at").isNull()).select(*columns, "group"))
        if not made["cut"]:
            break
        value = reduce(lambda other, i: F.when(F.col("column") == i, F.col(columns[i]).cast("double")).otherwise(other), range(len(columns)), F.lit(None).cast("double"))
        low = F.when(F.col("strict"), value < F.col("at")).otherwise(value <= F.col("at"))
        cut = met.where(F.col("at").isNotNull()).withColumn("_low", low)
        cut = cut.withColumn("group", F.concat("group", F.when(F.col("_low"), "l").otherwise("h")))
        cut = settle(cut.select(*columns, "group", (F.when(F.col("_low"), F.col("low")).otherwise(F.col("high")) <= most).alias("_small")), "open")
        if made["large"] < 2 * made["cut"]:
            small.append(cut.where("_small").drop("_small"))
        rows, groups = cut.where("NOT _small").drop("_small"), made["large"]
    parts = []
    if small:
        tasks = min(ends["n"] // most + 1, MOST_TASKS)
        parts.append(settle(_finished(reduce(DataFrame.unionByName, small), columns, k, spans, tasks), "finished"))
    if closed:
        every = settle(reduce(DataFrame.unionByName, closed), "closed")
        ranges = every.groupBy("group").agg(
            *[f(c).alias(f"{c}_{end}") for c in columns for f, end in ((F.min, "low"), (F.max, "high"))], F.count(F.lit(1)).alias("group_size")
        )
        parts.append(join_groups(every.distinct(), settle(ranges, "ranges"), "inner").drop("group"))
    return reduce(DataFrame.unionByName, parts)


def k_anonymous(df: DataFrame, columns: Sequence[str], k: int, accuracy: int = ACCURACY) -> DataFrame:
    """``df`` with each of the numeric ``columns`` replaced by ``<column>_low`` and ``<column>_high``, and ``group_size`` (at least ``k``).

    The rows of a group have the same ranges, so none can be told from ``k - 1`` others by them.  Rows with a null or NaN in one of the columns are
    left out, and so is a table of fewer than ``k`` other rows; :func:`suppressed` counts both.  Ranges are those of the rows, not of the cuts.
    """
    if k < 1:
        raise ValueError("k is at least 1")
    columns = list(columns)
    groups = groups_of(df, columns, k, accuracy)
    rest = [c for c in df.columns if c not in columns]
    ranges = [f"{c}_{end}" for c in columns for end in ("low", "high")]
    return df.where(_whole(columns)).join(groups, columns).select(*rest, *ranges, "group_size")


def suppressed(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """``(rows_in, incomplete, too_few)``: one row that counts what :func:`k_anonymous` leaves out."""
    whole = F.count_if(_whole(list(columns)))
    counts = df.agg(F.count(F.lit(1)).alias("rows_in"), whole.alias("whole"))
    return counts.select("rows_in", (F.col("rows_in") - F.col("whole")).alias("incomplete"), F.when(F.col("whole") < k, F.col("whole")).otherwise(0).alias("too_few"))
