"""Splitting the rows of very large keys into ordered slices.

A window over one key is one task, however many rows the key has.  The functions
here cut the few keys that hold too many rows into slices that follow one another
in time, so that each slice can be its own window partition.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: a key with fewer rows than this is never split
HOT_ROWS = 1_000_000

#: at most this many keys (or slices) count as hot, whatever the data holds: a key
#: is hot only above total / MAX_HOT rows.  It bounds every broadcast made here.
MAX_HOT = 100_000


def hot_limits(rows: Mapping[str, DataFrame], hot_rows: int = HOT_ROWS) -> dict[str, float]:
    """For each key that has hot values, the number of rows that makes a value hot.

    ``rows`` maps a key column to the rows to look at.  The limit is
    ``max(hot_rows, total / MAX_HOT)``.  One job counts rows per value of every key,
    combined before the shuffle.  It runs up front, so that the plan of the usual
    case, no hot key at all, stays a plain window.
    """
    sizes = [
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.lit(key).alias("key"), F.max("_n").alias("largest"), F.sum("_n").alias("total"))
        for key, df in rows.items()
    ]
    limits = {}
    for found in reduce(DataFrame.unionAll, sizes).collect():
        limit = max(hot_rows, (found.total or 0) / MAX_HOT)
        if (found.largest or 0) > limit:
            limits[found.key] = limit
    return limits


def hot_groups(rows: DataFrame, by: list[str], limit: float, stats: dict[str, Column] | None = None) -> DataFrame:
    """Groups with more than ``limit`` rows, where :func:`hot_limits` keeps them below ``MAX_HOT``."""
    columns = {"_n": F.count(F.lit(1)), **(stats or {})}
    return rows.groupBy(*by).agg(*[c.alias(n) for n, c in columns.items()]).filter(F.col("_n") > limit)


def hot_slices(
    rows: DataFrame, key: str, position: str, tie_break: str, limit: float
) -> list[DataFrame]:
    """How the values of ``key`` with more than ``limit`` rows are cut: one bounded table per level.

    Level one cuts the time a hot key spans into equal parts.  Each further level
    does the same inside a part that still holds too many rows, by ``tie_break`` if
    all of them share one position, until no part holds too many.  Rows that share position and
    ``tie_break`` cannot be told apart and stay together.
    """
    narrow = rows.select(key, position, tie_break)
    stats = {
        "_lo": F.min(position),
        "_hi": F.max(position),
        "_id_lo": F.min(tie_break),
        "_id_hi": F.max(tie_break),
    }
    in_time = F.col("_hi") > F.col("_lo")
    first = F.when(in_time, F.col("_lo")).otherwise(F.col("_id_lo"))
    span = F.when(in_time, F.col("_hi") - F.col("_lo")).otherwise(F.col("_id_hi") - F.col("_id_lo")) + 1
    parts = F.ceil(2 * F.col("_n") / F.lit(limit))
    width = F.greatest(F.lit(1), F.ceil(span / parts)).cast("long")
    tables: list[DataFrame] = []
    inside = narrow
    while True:
        by = [key, *slice_names(key, len(tables))]
        hot = hot_groups(inside, by, limit, stats).filter(in_time | (F.col("_id_hi") > F.col("_id_lo")))
        table = _fixed(hot.select(*by, in_time.alias("_in_time"), first.alias("_first"), width.alias("_width")))
        if table.isEmpty():
            break
        tables.append(table)
        inside = apply_slices(rows_of_hot_keys(narrow, key, tables[0]), key, position, tie_break, tables)
    return tables


def _fixed(table: DataFrame) -> DataFrame:
    """Compute a table of hot groups (under ``MAX_HOT`` rows) once."""
    return table.sparkSession.createDataFrame(table.collect(), table.schema)


def slice_names(key: str, levels: int) -> list[str]:
    return [f"_{key}_slice_{level}" for level in range(1, levels + 1)]


def join_hot(rows: DataFrame, hot: DataFrame, by: list[str], how: str) -> DataFrame:
    """Join the bounded table of hot groups; NULL keys match each other."""
    renamed = hot.withColumnsRenamed({c: f"_hot_{c}" for c in by})
    condition = reduce(and_, [rows[c].eqNullSafe(renamed[f"_hot_{c}"]) for c in by])
    return rows.join(F.broadcast(renamed), condition, how).drop(*[f"_hot_{c}" for c in by])


def apply_slices(rows: DataFrame, key: str, position: str, tie_break: str, tables: list[DataFrame]) -> DataFrame:
    """Add one slice column per level; 0 for whatever is not cut.

    Within a key, slices grow with ``(position, tie_break)``.
    """
    at = F.when(F.col("_in_time"), F.col(position)).otherwise(F.col(tie_break))
    number = F.floor((at - F.col("_first")) / F.col("_width")).cast("long")
    by = [key]
    for name, table in zip(slice_names(key, len(tables)), tables, strict=True):
        rows = (
            join_hot(rows, table, by, "left")
            .withColumn(name, F.coalesce(number, F.lit(0).cast("long")))
            .drop("_in_time", "_first", "_width")
        )
        by = [*by, name]
    return rows


def rows_of_hot_keys(rows: DataFrame, key: str, table: DataFrame) -> DataFrame:
    return join_hot(rows, table.select(key), [key], "inner")


def lead_in(
    hot_only: DataFrame,
    key: str,
    slices: list[str],
    order: list[str],
    carry: list[str],
    length: int,
) -> DataFrame:
    """For each slice of a hot key, the last ``length`` rows before it.

    Each slice offers its own last rows (at most ``length``, cut before the
    shuffle), and takes what it needs from the slices before it; a slice has at
    least one row, so looking ``length`` slices back is always enough.
    """
    newest_first = [F.col(c).desc() for c in order]
    in_slice = Window.partitionBy(key, *slices).orderBy(*newest_first)
    fields = [*order, *[c for c in carry if c not in order]]
    tails = (
        hot_only.select(key, *slices, *fields)
        .withColumn("_rank", F.row_number().over(in_slice))
        .filter(F.col("_rank") <= length)
        .groupBy(key, *slices)
        .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("_tail"))
    )
    earlier = Window.partitionBy(key).orderBy(*slices).rowsBetween(-length, -1)
    before = F.flatten(F.collect_list("_tail").over(earlier))
    return (
        tails.withColumn("_before", before)
        .withColumn("_before", F.slice("_before", F.greatest(F.size("_before") - length + 1, F.lit(1)), length))
        .select(key, *slices, F.inline("_before"))
    )
