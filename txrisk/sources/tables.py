"""CSV and Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.schema import RAW_TX


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_TX) -> DataFrame:
    """Raw transactions from CSV.

    Lines that begin with ``#`` (the header is one) are comments.  A field that
    does not fit its type, or is missing at the end of a short row, is NULL.
    """
    return spark.read.schema(schema).option("comment", "#").option("mode", "PERMISSIVE").csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write rows in the form :func:`read_raw_csv` reads: every file has a ``#`` header line.

    The writer is told another comment sign, or it would quote the header.
    """
    first = df.columns[0]
    df.withColumnRenamed(first, f"#{first}").write.mode(mode).options(header="true", comment="~").csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table with its stored schema."""
    return spark.read.parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    n_files: int | None = None,
    sort_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> None:
    """Write a Parquet table.

    ``sort_by`` range-partitions and sorts, so that files follow one another in
    that order and carry narrow min/max statistics.  The whole row is hashed in
    after ``sort_by``, so a value that very many rows share is spread over several
    files.  ``n_files`` alone only sets the number of files.
    """
    if sort_by:
        spread = F.xxhash64(*df.columns)
        keys = [F.col(c) for c in sort_by]
        n = (n_files,) if n_files else ()
        df = df.repartitionByRange(*n, *keys, spread).sortWithinPartitions(*partition_by, *sort_by)
    elif n_files:
        df = df.repartition(n_files)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
