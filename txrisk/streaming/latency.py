"""Time from event to answer for each message, kept as sketches that merge.

A sketch counts messages per bucket of time, and buckets grow by a fixed ratio, so a quantile taken from it is off by ``ACCURACY`` of its value
at most.  Sketches merge by adding counts: of micro-batches, of windows, of streams.  A window has at most some 2,000 buckets,
however many messages it holds.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: largest relative error of a quantile
ACCURACY = 0.01
SKETCH = "window_start timestamp, bucket int, messages long, total_us long, least_us long, most_us long"


def _ratio(accuracy: float) -> float:
    return (1 + accuracy) / (1 - accuracy)


def latency_sketch(answers: DataFrame, event: str = "ts", answered: str | Column = "answered", window: str = "1 minute", accuracy: float = ACCURACY) -> DataFrame:
    """``SKETCH`` rows of a table of answers: one per window of event time and bucket, counted before the shuffle.

    Times are timestamps; rows without one of them are left out.  An answer no later than its event (clocks differ) is in bucket -1, which stands for 0.
    """
    at = F.col(answered) if isinstance(answered, str) else answered
    taken = answers.select(F.window(event, window)["start"].alias("window_start"), (F.unix_micros(at) - F.unix_micros(event)).alias("us")).where("us IS NOT NULL")
    bucket = F.when(F.col("us") <= 0, F.lit(-1)).otherwise(F.ceil(F.log("us") / F.lit(math.log(_ratio(accuracy)))).cast("int"))
    return taken.groupBy("window_start", bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("messages"), F.sum("us").alias("total_us"), F.min("us").alias("least_us"), F.max("us").alias("most_us")
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ("window_start",)) -> DataFrame:
    """Sketches of the same ``by`` added up; without ``by``, all of them."""
    return sketches.groupBy(*by, "bucket").agg(
        F.sum("messages").alias("messages"), F.sum("total_us").alias("total_us"), F.min("least_us").alias("least_us"), F.max("most_us").alias("most_us")
    )


def latency_summary(sketches: DataFrame, quantiles: Sequence[float] = (0.5, 0.95, 0.99), by: Sequence[str] = ("window_start",), accuracy: float = ACCURACY) -> DataFrame:
    """Messages, total, least, most and quantiles (``p50_ms``, ...) of the time to answer, in milliseconds."""
    by = list(by)
    merged = merge_sketches(sketches, by)
    # a window over one ``by`` holds its buckets, never its messages
    upto = Window.partitionBy(*by).orderBy("bucket")
    ranked = merged.withColumn("upto", F.sum("messages").over(upto)).withColumn("n", F.sum("messages").over(Window.partitionBy(*by)))
    ratio = F.lit(_ratio(accuracy))

    def quantile(q: float) -> Column:
        rank = F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(float(q))))
        bucket = F.min(F.when(F.col("upto") >= rank, F.col("bucket")))
        value = F.when(bucket < 0, F.lit(0.0)).otherwise(2 * F.pow(ratio, bucket) / (ratio + 1))
        return (value / 1000).alias(f"p{q * 100:g}_ms".replace(".", "_"))

    return ranked.groupBy(*by).agg(
        F.sum("messages").alias("messages"), (F.sum("total_us") / 1000).alias("total_ms"), (F.min("least_us") / 1000).alias("least_ms"),
        (F.max("most_us") / 1000).alias("most_ms"), *[quantile(q) for q in quantiles],
    )


def answer_timed(answers: DataFrame, path: str, log: str, checkpoint: str, event: str = "ts", answered: str | None = None,
                 window: str = "1 minute", accuracy: float = ACCURACY, available_now: bool = True) -> StreamingQuery:
    """Write a stream of answers to ``path`` and the sketch of each micro-batch's times to ``log``.

    Without a column ``answered`` a message counts as answered when its micro-batch is written, by the clock.  Both go to a
    folder of the micro-batch's number, which a repeated micro-batch replaces, so no message is counted twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        out = f"{path}/batch={number}"
        batch.write.mode("overwrite").parquet(out)
        written = batch.sparkSession.read.schema(batch.schema).parquet(out)
        at = answered or F.lit(datetime.datetime.now(datetime.timezone.utc))
        latency_sketch(written, event, at, window, accuracy).write.mode("overwrite").parquet(f"{log}/batch={number}")

    writer = answers.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
