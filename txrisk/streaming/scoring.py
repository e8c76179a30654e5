"""Scoring a stream of messages and counting what comes out."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from txrisk.schema import MESSAGE
from txrisk.streaming.messages import mark

PROGRESS = "query_id string, batch_id long, input_rows long, rows_per_second double, duration_ms long, scored long, positives long, rejects long"

#: name under which a scoring plan reports its counts
COUNTS = "scoring"


def predictions(messages: DataFrame, model: PipelineModel, schema: T.StructType = MESSAGE) -> DataFrame:
    """Every message decoded, with the prediction of the model; ``key`` is carried along.

    A message that does not decode has no prediction, and ``rejected`` lists the fields at fault
    (it is empty for the others).  The model sees zeros in their place, as it takes no NULLs.
    """
    marked = mark(messages, schema).drop("value")
    filled = marked.select("*", F.struct(*schema.names).alias("_sent")).fillna(0, schema.names)
    scored = model.transform(filled)
    given = {n: F.col(f"_sent.{n}") for n in schema.names}
    scored = scored.withColumns(given).withColumn("prediction", F.when(F.col("rejected") == "", F.col("prediction")))
    return scored.select(*marked.columns, "prediction")


def score_stream(messages: DataFrame, model: PipelineModel) -> DataFrame:
    """Replies ``(key, value)``, one per message: ``{"prediction": x}``, or ``{"rejected": fields}``.

    The same plan serves a table and a stream: it is stateless and runs once per
    micro-batch, never per message.  On the way it counts what it scored, what of that was positive
    and what it rejected, which :func:`progress_rows` and :class:`ProgressLog` show per micro-batch.
    """
    done = predictions(messages, model).observe(
        COUNTS,
        F.count("prediction").alias("scored"),
        F.count_if(F.col("prediction") == 1).alias("positives"),
        F.count_if(F.col("rejected") != "").alias("rejects"),
    )
    reply = F.to_json(F.struct("prediction", F.nullif("rejected", F.lit("")).alias("rejected")))
    return done.select("key", reply.alias("value"))


def prediction_counts(
    scored: DataFrame, time: str = "ts", window: str = "1 minute", watermark: str = "10 minutes", prediction: str = "prediction"
) -> DataFrame:
    """Predictions and positive predictions per window of event time.

    On a stream the watermark closes windows, so state stays small; in append mode a window
    comes out once it is closed.
    """
    if scored.isStreaming:
        scored = scored.withWatermark(time, watermark)
    return (
        scored.groupBy(F.window(time, window).alias("_w"))
        .agg(
            F.count(F.lit(1)).alias("predictions"),
            F.count_if(F.col(prediction) == 1).alias("positives"),
        )
        .select(F.col("_w.start").alias("window_start"), "predictions", "positives")
    )


def progress_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Recent micro-batches of a query, as far as Spark retains them; :class:`ProgressLog` keeps all."""
    return spark.createDataFrame([_progress(p) for p in query.recentProgress], PROGRESS)


def _progress(progress) -> tuple:
    p = json.loads(progress.json)
    counts = (p.get("observedMetrics") or {}).get(COUNTS) or {}
    return (
        p["id"],
        p["batchId"],
        p["numInputRows"],
        float(p.get("processedRowsPerSecond") or 0.0),
        p["durationMs"]["triggerExecution"],
        *(counts.get(n) for n in ("scored", "positives", "rejects")),
    )


class ProgressLog(StreamingQueryListener):
    """Appends a row for each micro-batch of each query to a Parquet table.

    Add it with ``spark.streams.addListener``.  Rows are written ``every`` so many, and when a query ends.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every, self.rows = spark, path, every, []

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.rows.append(_progress(event.progress))
        if len(self.rows) >= self.every:
            self.flush()

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.flush()

    def flush(self) -> None:
        if self.rows:
            rows, self.rows = self.rows, []
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
