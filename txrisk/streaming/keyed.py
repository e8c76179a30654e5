"""Rolling features with the last rows of each key in the state store."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from txrisk.functions import epoch_micros
from txrisk.operators.features import AMOUNT, CUSTOMER, CUSTOMER_COUNT, CUSTOMER_MEAN, ID, TERMINAL, TERMINAL_COUNT, TIME
from txrisk.schema import FRAMES

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: keys are dealt to so many groups of state; a checkpoint holds for one number of them
SLOTS = 1024
KEY = T.StructType([T.StructField("key", T.StringType())])
#: the last rows of a key are one row of state, in order of time and id
LAST = T.StructType(
    [
        T.StructField("at", T.ArrayType(T.LongType())),
        T.StructField("id", T.ArrayType(T.LongType())),
        T.StructField("amount", T.ArrayType(T.DoubleType())),
    ]
)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the time a query is started in; a started query keeps its own copy."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def frames_of_keys(amounts: np.ndarray, depth: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``frame_values`` for the rows of several keys, one key after the other; ``depth`` rows of its own key come before a row."""
    m = len(amounts)
    priced = ~np.isnan(amounts)
    filled = np.where(priced, amounts, 0.0)
    sums, held = np.zeros(m), np.zeros(m)
    for back in range(min(n, max(m - 1, 0)), -1, -1):
        inside = depth[back:] >= back
        sums[back:] += np.where(inside, filled[: m - back], 0.0)
        held[back:] += inside & priced[: m - back]
    with np.errstate(invalid="ignore"):
        return np.minimum(depth + 1, n + 1), sums / held


class LastRows(StatefulProcessor):
    """Keeps the last rows of each key of a slot as map state, and gives each new row the statistics of its frames.

    A slot's keys share one table and one call per micro-batch; a key costs one read and one write of its state.
    """

    def __init__(self, names: dict[int, tuple[str, str | None]], columns: list[str], ttl_ms: int | None):
        self.names, self.columns, self.ttl_ms = names, columns, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", KEY, LAST, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = pd.concat(list(rows), ignore_index=True)
        codes, found = pd.factorize(new["state_key"], use_na_sentinel=False)
        keys = [(k if isinstance(k, str) else None,) for k in found]
        order = np.lexsort((new["state_id"].to_numpy(np.int64), new["at_micros"].to_numpy(np.int64), codes))
        new, codes = new.iloc[order].reset_index(drop=True), codes[order]
        at, ids = new["at_micros"].to_numpy(np.int64), new["state_id"].to_numpy(np.int64)
        held = [self.last.getValue(k) or ([], [], []) for k in keys]
        least = np.iinfo(np.int64).min
        newest = np.array([(h[0][-1], h[1][-1]) if len(h[0]) else (least, least) for h in held], np.int64)
        newest_at, newest_id = newest[codes].T
        # of rows that are late for another key already, nothing is worked out either
        late = (at < newest_at) | ((at == newest_at) & (ids <= newest_id) & (newest_at > least)) | new["late"].to_numpy(bool)
        kept = np.flatnonzero(~late)
        # what is held for a key, then its new rows, one key after the other
        owner = np.concatenate([np.repeat(np.arange(len(keys)), [len(h[0]) for h in held]), codes[kept]])
        before = len(owner) - len(kept)
        turn = np.argsort(owner, kind="stable")
        owner = owner[turn]

        def joined(part: int, fresh: np.ndarray) -> np.ndarray:
            return np.concatenate([*(np.asarray(h[part], fresh.dtype) for h in held), fresh])[turn]

        at, ids, amounts = joined(0, at[kept]), joined(1, ids[kept]), joined(2, new[AMOUNT].to_numpy(float)[kept])
        begin, end = np.searchsorted(owner, np.arange(len(keys))), np.searchsorted(owner, np.arange(len(keys)), "right")
        depth = np.arange(len(owner)) - begin[owner]
        fresh = turn >= before
        columns = {"late": late}
        for n, (count, mean) in self.names.items():
            for name, values in zip((count, mean), frames_of_keys(amounts, depth, n), strict=True):
                if name:
                    columns[name] = np.full(len(new), np.nan)
                    columns[name][kept[turn[fresh] - before]] = values[fresh]
            columns[count] = columns[count].astype("float32")
        for k in np.unique(codes[kept]):
            last = slice(max(begin[k], end[k] - max(self.names)), end[k])
            self.last.updateValue(keys[k], (at[last].tolist(), ids[last].tolist(), amounts[last].tolist()))
        yield new.assign(**columns)[self.columns]

    def close(self) -> None:
        pass


def _rolled(rows: DataFrame, key: str, names: dict[int, tuple[str, str | None]], ttl_ms: int | None) -> DataFrame:
    fields = list(rows.schema.fields)
    for count, mean in names.values():
        fields.append(T.StructField(count, T.FloatType()))
        fields += [T.StructField(mean, T.DoubleType())] if mean else []
    out = T.StructType(fields)
    processor = LastRows(names, out.names, ttl_ms)
    mode = "ProcessingTime" if ttl_ms else "None"
    slotted = rows.withColumns(
        {"state_slot": F.pmod(F.xxhash64(key), F.lit(SLOTS)), "state_key": F.col(key).cast("string"), "state_id": F.coalesce(ID, F.lit(-(2**63)))}
    )
    return slotted.groupBy("state_slot").transformWithStateInPandas(processor, out, "Append", mode)


def with_rolling_features(source: DataFrame, frames: Sequence[int] = FRAMES, ttl_ms: int | None = None) -> DataFrame:
    """``source`` with all its columns, the rolling features of customer and terminal, and ``late``."""
    taken = {c.lower() for c in source.columns}
    clash = taken & {"at_micros", "late", "state_slot", "state_key", "state_id"}
    if clash:
        raise ValueError(f"columns of these names are added: {sorted(clash)}")
    rows = source.withColumns({"at_micros": F.coalesce(epoch_micros(TIME), F.lit(-(2**61))), "late": F.lit(False)})
    rows = _rolled(rows, CUSTOMER, {n: (CUSTOMER_COUNT.format(n), CUSTOMER_MEAN.format(n)) for n in frames}, ttl_ms)
    rows = _rolled(rows, TERMINAL, {n: (TERMINAL_COUNT.format(n), None) for n in frames}, ttl_ms)
    return rows.drop("at_micros")


def rolling_features_state(
    source: DataFrame,
    path: str,
    checkpoint: str,
    frames: Sequence[int] = FRAMES,
    ttl_ms: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """All rolling features of a stream, from state per customer and per terminal, written to ``path`` as Parquet.

    The state store holds the last ``max(frames)`` rows of each key, and a micro-batch reads and writes those of its own
    keys only, however many keys there were before.  With ``ttl_ms``, a key not heard of for that long is forgotten.
    Rows of a micro-batch are put in order of time and id; all columns are kept.  A row that comes before one of its
    customer's or terminal's in an earlier micro-batch (or is that row again) is ``late``: it has no features for
    the key it is late for, nor for the terminal if it is late for its customer, and counts in no later frame of these.

    Keys are dealt to ``SLOTS`` groups by a hash, so a micro-batch costs so many calls at most and, for each of its keys, one
    read and one write of state.  The rows of a group in one micro-batch are worked through in one task; the source's limit on the size of a
    micro-batch bounds them.  ``rolling_features_batches`` is the form that cuts hot keys.
    """
    with setting(source.sparkSession, PROVIDER, ROCKSDB):
        rolled = with_rolling_features(source, frames, ttl_ms)
        writer = rolled.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        if available_now:
            writer = writer.trigger(availableNow=True)
        return writer.start()


def state_reads(query: StreamingQuery) -> list[int]:
    """Rows that each micro-batch touched in the state store, of those the query has reports of."""
    return [sum(op.numRowsUpdated for op in p.stateOperators) for p in query.recentProgress if p.numInputRows]
