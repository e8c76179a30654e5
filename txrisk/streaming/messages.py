"""JSON messages: reading, writing, encoding and decoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from txrisk.functions.columns import hash_bucket
from txrisk.operators import sampling
from txrisk.schema import MESSAGE, MESSAGE_FIELDS
from txrisk.session import settle

KEY_VALUE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])

#: where a message was stored; the Kafka source supplies these
METADATA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

#: how much one micro-batch takes at most, unless the caller says otherwise
RATE_LIMITS = {"kafka": {"maxOffsetsPerTrigger": "1000000"}, "file": {"maxFilesPerTrigger": "100"}}


def read_messages(
    spark: SparkSession, fmt: str, options: Mapping[str, str], keep_metadata: bool = False
) -> DataFrame:
    """A stream of ``(key, value)`` text messages, from Kafka or from a folder of files.

    ``keep_metadata`` adds topic, partition, offset and timestamp.  A micro-batch is
    limited in size, so a backlog is worked off in steps and one key's share of a
    micro-batch is limited too.
    """
    limits = RATE_LIMITS.get(fmt, RATE_LIMITS["file"])
    reader = spark.readStream.format(fmt).options(**{**limits, **options})
    if fmt != "kafka":
        fields = [*KEY_VALUE, *METADATA] if keep_metadata else [*KEY_VALUE]
        reader = reader.schema(T.StructType(fields))
    text = [F.col(f.name).cast("string").alias(f.name) for f in KEY_VALUE]
    return reader.load().select(*text, *(METADATA.names if keep_metadata else []))


def write_messages(
    df: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    checkpoint: str | None = None,
    available_now: bool = False,
) -> StreamingQuery | None:
    """Send ``(key, value)`` rows to Kafka or to files; ``checkpoint`` is needed for a stream.

    ``available_now`` works off what there is and stops.
    """
    if not df.isStreaming:
        df.write.format(fmt).options(**options).mode("append").save()
        return None
    writer = df.writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.outputMode("append").start()


def encode(fields: Sequence[str] = MESSAGE_FIELDS) -> Column:
    """The named columns as one JSON object."""
    return F.to_json(F.struct(*fields))


def to_messages(df: DataFrame, key: str = "tx_datetime", fields: Sequence[str] = MESSAGE_FIELDS) -> DataFrame:
    """Rows as ``(key, value)`` messages.

    A transaction id makes a better key than the time of the transaction, which
    several may share.
    """
    return df.select(F.col(key).cast("string").alias("key"), encode(fields).alias("value"))


def replay(df: DataFrame, k: int, seed: int, key: str = "transaction_id") -> DataFrame:
    """Messages of ``k`` random rows, to feed a scoring stream."""
    return to_messages(sampling.random_rows(df, k, seed, key), key)


def numbered_messages(df: DataFrame, seed: int | str, key: str = "transaction_id", fields: Sequence[str] = MESSAGE_FIELDS) -> DataFrame:
    """``(index, key, value)``: the rows of a table as messages, numbered in a seeded random order and stored."""
    rows = sampling.numbered(df, seed, key).select("index", F.col(key).cast("string").alias("key"), encode(fields).alias("value"))
    return settle(rows, "numbered")


def replay_stream(numbers: DataFrame, rows: DataFrame, seed: int | str) -> DataFrame:
    """``(number, key, value)``: an endless producer.  Each number of a stream becomes the message of a random row.

    ``numbers`` has a column ``value``, such as Spark's ``rate`` source gives; ``rows`` are :func:`numbered_messages`.  Which row a number takes follows
    from its hash, so a restart sends the same message again, if any, and no message scans the table: a
    micro-batch is one join of its numbers with the table.
    """
    n = rows.count()
    index = hash_bucket("value", seed, sampling.BUCKETS) % F.lit(n)
    asked = numbers.select(F.col("value").alias("number"), index.alias("index"))
    return asked.join(rows, "index").select("number", "key", "value")


def ledger(delivered: DataFrame, block: int = 1_000_000) -> DataFrame:
    """What was delivered, per topic and partition: ``(topic, partition, first, last, messages, repeats, missing_before)``.

    A row is a range of offsets without a gap; ``messages`` counts its offsets, ``repeats`` what came more than once, and
    ``missing_before`` the offsets between the range before and this one.  Copies are counted before the shuffle, ranges are
    found per block of offsets first, so a partition with very many messages is spread over tasks, and then joined where they meet.
    """
    of = ["topic", "partition"]
    offsets = delivered.groupBy(*of, "offset").agg(F.count(F.lit(1)).alias("times"))
    blocked = offsets.withColumn("block", F.floor(F.col("offset") / block))
    island = F.col("offset") - F.row_number().over(Window.partitionBy(*of, "block").orderBy("offset"))
    found = blocked.withColumn("island", island).groupBy(*of, "block", "island").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.sum(F.col("times") - 1).alias("repeats")
    )
    ordered = Window.partitionBy(*of).orderBy("first")
    starts = F.coalesce((F.lag("last").over(ordered) + 1 < F.col("first")).cast("int"), F.lit(1))
    found = found.withColumn("starts", starts).withColumn("range", F.sum("starts").over(ordered))
    ranges = found.groupBy(*of, "range").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("repeats").alias("repeats"))
    missing = F.coalesce(F.col("first") - F.lag("last").over(ordered) - 1, F.lit(0))
    return ranges.select(*of, "first", "last", (F.col("last") - F.col("first") + 1).alias("messages"), "repeats", missing.alias("missing_before"))


def mark(messages: DataFrame, schema: T.StructType = MESSAGE) -> DataFrame:
    """Decode ``value`` into columns and list in ``rejected`` the fields that are missing or wrong.

    Text that is not a JSON object lacks every field.
    """
    fields = [F.col(n) for n in schema.names]
    faults = F.concat_ws(",", *[F.when(f.isNull(), F.lit(n)) for f, n in zip(fields, schema.names, strict=True)])
    return _parsed(messages, schema).withColumn("rejected", faults)


def _parsed(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of ``value`` as columns.

    The parsed object goes through a generator, which a filter on its fields cannot
    pass; else the optimizer would parse the text again for each field in the filter.
    """
    others = [c for c in messages.columns if c not in schema.names]
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE"})
    return messages.select(*others, F.inline_outer(F.array(parsed)))


def decode(messages: DataFrame, schema: T.StructType = MESSAGE) -> tuple[DataFrame, DataFrame]:
    """Messages that decode, as columns, and the others as they came with the fields at fault."""
    whole = reduce(and_, [F.col(n).isNotNull() for n in schema.names])
    good = _parsed(messages, schema).filter(whole).drop("value")
    bad = mark(messages, schema).filter(~whole).select(*[c for c in messages.columns if c not in schema.names], "rejected")
    return good, bad
