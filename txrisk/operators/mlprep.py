"""Scaling and category encoding as columns, and the matching Spark ML stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.operators.ordered import running_totals
from txrisk.schema import MESSAGE_FIELDS

#: columns of the baseline model (fixed values)
SCENARIO = "tx_fraud_scenario"
BASELINE_COLUMNS = ("tx_amount", "tx_time_seconds", "tx_time_days")


def minmax_bounds(df: DataFrame, columns: Sequence[str] = MESSAGE_FIELDS) -> DataFrame:
    """One row with ``min_<column>`` and ``max_<column>``, in one pass."""
    return df.agg(
        *[F.min(c).alias(f"min_{c}") for c in columns],
        *[F.max(c).alias(f"max_{c}") for c in columns],
    )


def minmax_scale(
    df: DataFrame, columns: Sequence[str] = MESSAGE_FIELDS, suffix: str = "_scaled", fit_on: DataFrame | None = None
) -> DataFrame:
    """Columns scaled to 0..1; a constant column becomes 0.5."""
    bounds = minmax_bounds(df if fit_on is None else fit_on, columns)
    one = bounds.select(F.struct(*bounds.columns)).scalar()

    def scaled(c: str) -> Column:
        low, high = F.col("_bounds")[f"min_{c}"].cast("double"), F.col("_bounds")[f"max_{c}"].cast("double")
        return F.when(high == low, 0.5).otherwise((F.col(c).cast("double") - low) / (high - low))

    return df.withColumn("_bounds", one).withColumns({f"{c}{suffix}": scaled(c) for c in columns}).drop("_bounds")


def index_categories(df: DataFrame, column: str = SCENARIO) -> DataFrame:
    """Categories by falling frequency, then by value as text: ``(column, n, index)``.

    Any number of categories is numbered: each range of the order counts its own, so no task sees all.
    The ordered counts are written to the shared folder once.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(-F.col("n"), F.col(column).cast("string"))
    numbered = running_totals(counts.withColumn("_one", F.lit(1).cast("long")), [], order, ["_one"])
    return numbered.select(column, "n", (F.col("_one_upto") - 1).alias("index"))


def encode_categories(df: DataFrame, column: str = SCENARIO, fit_on: DataFrame | None = None) -> DataFrame:
    """Add ``<column>_index``; NULL for a category ``fit_on`` does not have."""
    table = index_categories(df if fit_on is None else fit_on, column)
    table = table.select(F.col(column).alias("_category"), F.col("index").alias(f"{column}_index"))
    return df.join(table, F.col(column) == F.col("_category"), "left").drop("_category")


def onehot(df: DataFrame, index: str, size: int, prefix: str | None = None) -> DataFrame:
    """Add 0/1 columns for the indexes ``0 .. size-2``; the last category is all zeros."""
    prefix = prefix or index
    return df.withColumns({f"{prefix}_{i}": (F.col(index) == i).cast("int") for i in range(size - 1)})


def assembler(columns: Sequence[str] = MESSAGE_FIELDS, output: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=handle_invalid)


def scaler(input_col: str = "features", output: str = "scaledFeatures") -> MinMaxScaler:
    return MinMaxScaler(inputCol=input_col, outputCol=output)


def scenario_stages(
    use_scenario: bool = False, columns: Sequence[str] = BASELINE_COLUMNS, handle_invalid: str = "error"
) -> list:
    """Stages of the baseline model: amount and time, optionally the encoded scenario.

    The scenario tells whether a transaction is fraud, so it is left out by default.
    ``handle_invalid="keep"`` gives scenarios the fit has not seen a category of their own, and so one
    column more.
    """
    if not use_scenario:
        return [assembler(columns)]
    indexer = StringIndexer(inputCols=[SCENARIO], outputCols=[f"{SCENARIO}_index"], handleInvalid=handle_invalid)
    encoder = OneHotEncoder(inputCols=[f"{SCENARIO}_index"], outputCols=[f"{SCENARIO}_encoded"])
    return [indexer, encoder, assembler([*columns, f"{SCENARIO}_encoded"])]
