"""Rolling features computed on a stream, with the last amounts per key as state."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from txrisk.functions import epoch_micros
from txrisk.operators.features import (
    AMOUNT,
    CUSTOMER,
    CUSTOMER_COUNT,
    CUSTOMER_MEAN,
    ID,
    TERMINAL,
    TIME,
    last_rows,
    rolling_features,
)
from txrisk.operators.hotkeys import HOT_ROWS
from txrisk.schema import FRAMES
from txrisk.session import remove

#: micro-batches after which their tables of last rows become one
MERGE_EVERY = 64

STATE = T.StructType(
    [
        T.StructField("last", T.ArrayType(T.DoubleType())),
        T.StructField("held_at", T.ArrayType(T.LongType())),
        T.StructField("held_id", T.ArrayType(T.LongType())),
        T.StructField("held_amount", T.ArrayType(T.DoubleType())),
    ]
)


def frame_values(before: Sequence[float], amounts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and mean amount of the frame of ``n`` rows back, for each new amount.

    A frame is added up by itself, so amounts outside it leave its mean alone.  NaN stands for a
    missing amount: it counts as a row and not in the mean, which is NaN if all are missing.
    """
    first, m = len(before), len(amounts)
    values = np.concatenate([np.full(n, np.nan), np.asarray(before, dtype=float), amounts])
    priced = ~np.isnan(values)
    filled = np.where(priced, values, 0.0)
    sums, held = np.zeros(m), np.zeros(m)
    for i in range(first, first + n + 1):
        sums += filled[i : i + m]
        held += priced[i : i + m]
    counts = np.minimum(np.arange(first + 1, first + m + 1), n + 1)
    with np.errstate(invalid="ignore"):
        return counts, sums / held


def rolling_features_stream(
    source: DataFrame,
    key: str = CUSTOMER,
    count: str = CUSTOMER_COUNT,
    mean: str | None = CUSTOMER_MEAN,
    frames: Sequence[int] = FRAMES,
    hold: str | None = None,
) -> DataFrame:
    """Row-frame count and mean per key, for each transaction of a stream.

    State is the last ``max(frames)`` amounts of a key.  Rows of one micro-batch are
    put in order of time and id.  Input must then come in order from one micro-batch
    to the next, unless ``hold`` (such as ``"10 minutes"``) is given: rows then wait until
    the watermark has passed them, so rows that come up to that much late still find
    their place, and the result equals the batch result.  An amount that is NULL or not a number
    counts as a row and not in the means; a key may have any type.

    A key's share of a micro-batch is worked through in one task; the source's limit
    on the size of a micro-batch bounds it.
    """
    names = {n: (count.format(n), mean.format(n) if mean else None) for n in frames}
    fields = [
        T.StructField(ID, T.LongType()),
        T.StructField(key, source.schema[key].dataType),
        T.StructField("at", T.LongType()),
        T.StructField(AMOUNT, T.DoubleType()),
    ]
    for c, m in names.values():
        fields.append(T.StructField(c, T.FloatType()))
        if m:
            fields.append(T.StructField(m, T.DoubleType()))
    output = T.StructType(fields)
    longest = max(frames)

    def per_key(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, at, ids, amounts = state.get if state.exists else ([], [], [], [])
        # plain arrays: most keys have few rows, and a table of pandas costs more than their work
        parts = [[np.array(x) for x in (at, ids, amounts)]] if at else []
        parts += [[b[c].to_numpy() for c in ("at", ID, AMOUNT)] for b in batches if len(b)]
        if not parts:
            return
        at, ids, amounts = (np.concatenate(column) for column in zip(*parts, strict=True))
        order = np.lexsort((ids, at))
        at, ids, amounts = at[order], ids[order], amounts[order]
        passed = at <= state.getCurrentWatermarkMs() * 1000 if hold else np.ones(len(at), bool)
        new = amounts[passed].astype(float)
        if len(new):
            out = {ID: ids[passed], key: group[0], "at": at[passed], AMOUNT: amounts[passed]}
            for n, (c, m) in names.items():
                counts, means = frame_values(last, new, n)
                out[c] = counts.astype("float32")
                if m:
                    out[m] = means
            yield pd.DataFrame(out, columns=output.names)
        kept = [*last, *new[-longest:].tolist()][-longest:]
        waiting = at[~passed]
        state.update((kept, waiting.tolist(), ids[~passed].tolist(), amounts[~passed].tolist()))
        if len(waiting):
            due = int(waiting.min()) // 1000 + 1
            state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))

    timeout = GroupStateTimeout.NoTimeout
    rows = source.select(
        F.col(key),
        F.col(ID).cast("long").alias(ID),
        epoch_micros(TIME).alias("at"),
        F.col(AMOUNT),
        F.col(TIME).cast("timestamp").alias("ts"),
    )
    if hold:
        rows = rows.withWatermark("ts", hold)
        timeout = GroupStateTimeout.EventTimeTimeout
    return rows.groupBy(key).applyInPandasWithState(per_key, output, STATE, "append", timeout)


def _stored(spark: SparkSession, folder: str, key: str, number: int, longest: int) -> DataFrame:
    """Last rows of all micro-batches before ``number``: what was merged last, and what came since.

    Every ``MERGE_EVERY`` micro-batches the tables are merged into one; those that no repetition of a
    micro-batch can ask for any more are removed.
    """
    at, since = number - number % MERGE_EVERY, number % MERGE_EVERY

    def tables(merged: int, end: int) -> DataFrame:
        return spark.read.parquet(*([f"{folder}/upto-{merged}"] if merged else []), *[f"{folder}/{i}" for i in range(merged, end)])

    if at and not since:
        earlier = at - MERGE_EVERY
        last_rows(tables(earlier, at), key, longest).write.mode("overwrite").parquet(f"{folder}/upto-{at}")
        gone = range(max(0, earlier - MERGE_EVERY), earlier)
        remove(spark, f"{folder}/upto-{earlier - MERGE_EVERY}", *[f"{folder}/{i}" for i in gone])
    return tables(at, number)


def _before(batch: DataFrame, stored: DataFrame, key: str, longest: int) -> DataFrame:
    """Last rows, before the micro-batch, of the keys it holds."""
    keys = batch.select(F.col(key).alias("_key")).distinct()
    return last_rows(stored.join(keys, stored[key].eqNullSafe(keys["_key"]), "left_semi"), key, longest)


def _with_late(batch: DataFrame, earlier: Mapping[str, DataFrame]) -> DataFrame:
    """Add ``_late``: the row comes before one of its customer or terminal that was worked out already."""
    late = F.lit(False)
    for key, rows in earlier.items():
        newest = rows.groupBy(F.col(key).alias(f"_{key}")).agg(F.max(F.struct(TIME, ID)).alias(f"_newest_{key}"))
        batch = batch.join(newest, batch[key].eqNullSafe(newest[f"_{key}"]), "left")
        late = late | F.coalesce(F.struct(TIME, ID) < F.col(f"_newest_{key}"), F.lit(False))
    return batch.withColumn("_late", late).drop(*[f"{p}{k}" for k in earlier for p in ("_", "_newest_")])


def rolling_features_batches(
    source: DataFrame,
    path: str,
    checkpoint: str,
    frames: Sequence[int] = FRAMES,
    hot_rows: int | None = HOT_ROWS,
    available_now: bool = True,
    late: str | None = None,
) -> StreamingQuery:
    """All rolling features of a stream, one window plan per micro-batch, written to ``path``.

    The form for large micro-batches: everything runs as batch windows, so hot keys
    are cut as they are there, and no Python sees a row.  A micro-batch stores the last rows of its own
    customers and terminals in a table next to the checkpoint, and takes from those of
    the micro-batches before it the rows of its keys.  It overwrites only its own folders, so
    doing it again after a failure gives the same result.

    Input should come in order of time from one micro-batch to the next.  A row that comes before one of its
    customer or terminal in an earlier micro-batch is late: its frame, and those after it, are
    done.  It goes, without features, to ``late`` (``<checkpoint>/late`` if not given) and counts in no frame.
    """
    longest = max(frames)
    keys = (CUSTOMER, TERMINAL)

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        held = [batch.persist()]
        try:
            earlier = {}
            if number:
                for k in keys:
                    stored = _stored(spark, f"{checkpoint}/last-rows/{k}", k, number, longest)
                    earlier[k] = _before(batch, stored, k, longest).persist()
                held += earlier.values()
                marked = _with_late(batch, earlier).persist()
                held.append(marked)
                missed = marked.filter("_late").drop("_late")
                missed.write.mode("overwrite").parquet(f"{late or checkpoint + '/late'}/batch={number}")
                batch = marked.filter("not _late").drop("_late")
            rolled = rolling_features(batch, frames, hot_rows=hot_rows, earlier=earlier)
            rolled.write.mode("overwrite").parquet(f"{path}/batch={number}")
            for k in keys:
                last_rows(batch, k, longest).write.mode("overwrite").parquet(f"{checkpoint}/last-rows/{k}/{number}")
        finally:
            for df in held:
                df.unpersist()

    writer = source.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
