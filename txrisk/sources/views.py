"""Transaction tables seen in an ``events`` table.

``events(event_id, ts, user_id, event_type, value, props)`` carries the
transaction schema; the same rules are easy to write in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions import epoch_seconds
from txrisk.operators import features
from txrisk.schema import FEATURES, MESSAGE_FIELDS, RAW_TX
from txrisk.streaming.messages import encode, to_messages

#: 2024-01-01 00:00:00
FIRST_SECOND = 1_704_067_200


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean transactions: one per event."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    seconds = epoch_seconds("ts") - FIRST_SECOND
    fraud = F.col("event_type") == "error"
    return events.select(
        F.col("event_id").cast("long").alias("transaction_id"),
        F.col("ts").alias("tx_datetime"),
        F.col("user_id").cast("int").alias("customer_id"),
        F.get_json_object("props", "$.k").cast("int").alias("terminal_id"),
        F.col("value").cast("double").alias("tx_amount"),
        seconds.alias("tx_time_seconds"),
        F.floor(seconds / 86400).cast("long").alias("tx_time_days"),
        fraud.cast("int").alias("tx_fraud"),
        F.when(fraud, 1 + F.col("event_id") % 3).otherwise(0).cast("int").alias("tx_fraud_scenario"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as text dates, with defects and exact copies put in by rule."""
    every = lambda n: F.col("transaction_id") % n == 0
    text = F.date_format("tx_datetime", "yyyy-MM-dd HH:mm:ss")
    amount = F.when(every(17), -F.col("tx_amount")).otherwise(F.col("tx_amount"))
    return (
        transactions(spark, sf_dir)
        .withColumns(
            {
                "tx_amount": F.when(every(31), amount * 100).otherwise(amount),
                "terminal_id": F.when(~every(19), F.col("terminal_id")),
                "tx_datetime": F.when(every(29), "bad-date").when(every(23), "2024-02-30 00:00:00").otherwise(text),
            }
        )
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.when(every(10), 2).otherwise(1))))
        .select(*RAW_TX.names)
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with two fixed scores, a new and an old one, and their cuts at 0.5."""
    score = F.least(F.lit(1.0), F.col("tx_amount") / 200.0)
    return (
        transactions(spark, sf_dir)
        .withColumn("score", score)
        .withColumn("score_old", 1.0 - F.col("score"))
        .withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
        .withColumn("prediction_old", (F.col("score_old") >= 0.5).cast("int"))
    )


def keyed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table with the transaction id kept, to key messages with."""
    rolled = features.to_epoch(features.rolling_features(transactions(spark, sf_dir)))
    return rolled.select("transaction_id", *FEATURES.names)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``(key, value)`` message per transaction."""
    return to_messages(keyed_features(spark, sf_dir), key="transaction_id")


def faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which every 7th is no JSON, every 11th lacks a field and every 13th has a text in one."""
    every = lambda n: F.col("transaction_id") % n == 0
    rest = [f for f in MESSAGE_FIELDS if f != "tx_amount"]
    texted = F.to_json(F.struct(F.lit("much").alias("tx_amount"), *rest))
    value = F.when(every(7), "not json").when(every(11), encode(rest)).when(every(13), texted).otherwise(encode())
    return keyed_features(spark, sf_dir).select(F.col("transaction_id").cast("string").alias("key"), value.alias("value"))
