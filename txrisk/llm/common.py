"""Small helpers that the operators of this package share."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow batches are cut by rows and by bytes, so a Python worker holds a few long texts at most
BATCH_ROWS = 1024
BATCH_BYTES = 16 * 1024 * 1024

#: how often a task writes out what it has gathered
FLUSH_ROWS = 2048

#: words of 64 bits, at most, that tell which ids are wanted
FILTER_WORDS = 1 << 19


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of ``docs``; a null text is empty."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples, one batch in memory at a time."""
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def batches_of(rows: Iterable[tuple], schema: pa.Schema, flush: int = FLUSH_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``flush`` rows from tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= flush:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*held, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def ddl(schema: pa.Schema) -> str:
    """The Spark schema of an Arrow schema of plain types and lists of them."""
    names: Mapping[pa.DataType, str] = {
        pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary",
        pa.float64(): "double", pa.bool_(): "boolean",
    }

    def one(t: pa.DataType) -> str:
        return f"array<{one(t.value_type)}>" if pa.types.is_list(t) else names[t]

    return ", ".join(f"`{f.name}` {one(f.type)}" for f in schema)


def only(rows: DataFrame, key: str, wanted: DataFrame, name: str) -> DataFrame:
    """Rows whose ``key`` is among the values ``name`` of ``wanted`` (a null is a value), with some others.

    One bit of a hash per wanted value goes to all tasks in a table of bounded size, so rows that no join can need, such as long texts, are not
    shuffled; where more values are wanted than there are bits, all rows pass.  A join by the value itself, or by what is worked out from the row, must follow.
    A semi join is not moved below another one, so this stays before whatever follows.
    """

    def place(column: str):
        return F.pmod(F.xxhash64(column), F.lit(64 * FILTER_WORDS))

    word, bits = free_name(rows, "filter_word"), free_name(rows, "filter_bits")
    at = wanted.select(place(name).alias("at"))
    one = F.expr("shiftleft(1L, cast(at % 64 as int))")
    words = at.groupBy(F.shiftright("at", 6).alias(word)).agg(F.bit_or(one).alias(bits))
    held = F.getbit(F.col(bits), (place(key) % 64).cast("int")) == 1
    return rows.join(F.broadcast(words), (F.shiftright(place(key), 6) == F.col(word)) & held, "left_semi")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def lower_ascii(column):
    """Lower-case A-Z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


_UPPER = re.compile("[A-Z]+")


def lower_ascii_text(text: str) -> str:
    return text.lower() if text.isascii() else _UPPER.sub(lambda m: m[0].lower(), text)
