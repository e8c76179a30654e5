"""Finding the reply to a request by its key."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from txrisk.operators import quality

#: many rows of a key are one row of state, since every row of state is sent by itself
HELD = T.StructType([T.StructField("at", T.ArrayType(T.LongType())), T.StructField("value", T.ArrayType(T.StringType()))])
CHUNK = 1_000


def _chunks(held: list[tuple]) -> list[tuple]:
    return [tuple(map(list, zip(*held[i : i + CHUNK], strict=True))) for i in range(0, len(held), CHUNK)]


def _held(state) -> set:
    return {row for at, values in state.get() for row in zip(at, values, strict=True)}


def _order(row: tuple) -> tuple:
    at, value = row
    return at, value is not None, value or ""


def _ordered(rows: set) -> list:
    """Rows by time and value, a missing value first; only where one meets another of its time is a key needed."""
    try:
        return sorted(rows)
    except TypeError:
        return sorted(rows, key=_order)


class Pending(StatefulProcessor):
    """Requests of a key that wait for a reply, and the replies that may still be theirs."""

    def __init__(self, within: int):
        self.within = within

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.requests = handle.getListState("requests", HELD)
        self.replies = handle.getListState("replies", HELD)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new: dict[bool, set] = {True: _held(self.requests), False: _held(self.replies)}
        for batch in rows:
            for asks, at, value in zip(batch["asks"].tolist(), batch["at"].tolist(), batch["value"].tolist(), strict=True):
                new[asks].add((at, value if isinstance(value, str) else None))
        yield from self._answered(key, new[True], new[False], timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield from self._answered(key, _held(self.requests), _held(self.replies), timerValues)

    def _answered(self, key, requests: set, replies: set, timer_values) -> Iterator[pd.DataFrame]:
        passed = timer_values.getCurrentWatermarkInMs() * 1000  # all rows from before this have come
        told = [] if key[0] is None else _ordered(replies)
        times = [at for at, _ in told]
        done, waiting, due, needed = [], [], [], set()
        for at, value in _ordered(requests):
            last = at + self.within
            first = bisect_left(times, at)
            reply = told[first] if first < len(told) and times[first] <= last else None
            if reply and reply[0] < passed:
                done.append((key[0], value, at, reply[1], reply[0]))
            elif last < passed:
                done.append((key[0], value, at, None, None))
            else:
                waiting.append((at, value))
                due.append((reply[0] if reply else last) // 1000 + 1)
                needed.update([reply] if reply else [])
        # what a waiting request would take now, and what may be the reply to one that waits or comes yet
        kept = [r for r in told if r[0] >= passed or r in needed]
        for state, held in ((self.requests, waiting), (self.replies, kept)):
            state.put(_chunks(held)) if held else state.clear()
        if due:
            self.handle.registerTimer(min(due))
        if done:
            out = pd.DataFrame(done, columns=["key", "value", "at", "reply", "reply_at"])
            yield out.astype({"at": "Int64", "reply_at": "Int64"})

    def close(self) -> None:
        pass


def _micros(span: str, df: DataFrame) -> int:
    """An interval such as ``1 minute`` in microseconds."""
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp")
    return df.sparkSession.range(1).select(F.unix_micros(zero + F.expr(f"INTERVAL {span}")) - F.unix_micros(zero)).first()[0]


def _match_streams(requests: DataFrame, replies: DataFrame, within: str, delay: str) -> DataFrame:
    def side(df: DataFrame, asks: bool) -> DataFrame:
        rows = df.select("key", F.lit(asks).alias("asks"), "value", F.col("ts").cast("timestamp").alias("ts"))
        return rows.withWatermark("ts", delay).withColumn("at", F.unix_micros("ts"))

    answered = T.StructType(
        [
            T.StructField("key", requests.schema["key"].dataType),
            T.StructField("value", T.StringType()),
            T.StructField("at", T.LongType()),
            T.StructField("reply", T.StringType()),
            T.StructField("reply_at", T.LongType()),
        ]
    )
    both = side(requests, True).unionByName(side(replies, False)).filter(F.col("at").isNotNull())
    processor = Pending(_micros(within, requests))
    found = both.groupBy("key").transformWithStateInPandas(processor, answered, "Append", "EventTime")
    return found.select(
        "key", "value", F.timestamp_micros("at").alias("ts"), "reply", F.timestamp_micros("reply_at").alias("reply_ts")
    )


def match_replies(requests: DataFrame, replies: DataFrame, within: str = "1 minute", delay: str | None = None) -> DataFrame:
    """Each request with the earliest reply of its key that came in time; earlier and later ones do not count.

    Both sides are ``(key, value, ts)``; the result is ``(key, value, ts, reply,
    reply_ts)``, with NULLs for a request that got none.  Several requests may have one key, and one reply
    may be the first in time for several of them; rows that are equal in all columns are one request.

    On streams the rows of a key are state until they are settled: a request comes out once no earlier reply of its can
    come any more, or once its time is over, whichever is first, so the result is the batch result in whatever order
    the rows arrive.  ``delay`` (``within`` if not given) is how much later than newer rows a row may arrive; rows that
    come later still, and rows without a time, are left out.  The state store must be RocksDB, as
    :func:`txrisk.session.configure` sets it.
    """
    if requests.isStreaming:
        return _match_streams(requests, replies, within, delay or within)
    span = F.expr(f"INTERVAL {within}")
    answers = replies.select(
        F.col("key").alias("_key"), F.col("value").alias("reply"), F.col("ts").alias("reply_ts")
    )
    in_time = (F.col("reply_ts") >= F.col("ts")) & (F.col("reply_ts") <= F.col("ts") + span)
    matched = requests.join(answers, (F.col("key") == F.col("_key")) & in_time, "left")
    matched = matched.select("key", "value", "ts", "reply", "reply_ts")
    return quality.dedup(matched, ["key", "ts", "value"], order_by=["reply_ts", "reply"])
