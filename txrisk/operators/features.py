"""Rolling features per customer and per terminal."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from txrisk.functions import epoch_micros, epoch_seconds
from txrisk.operators.hotkeys import (
    HOT_ROWS,
    apply_slices,
    hot_limits,
    hot_slices,
    lead_in,
    rows_of_hot_keys,
    slice_names,
)
from txrisk.schema import FEATURE_DROPS, FEATURES, FRAMES

TIME = "tx_datetime"
ID = "transaction_id"
AMOUNT = "tx_amount"
CUSTOMER = "customer_id"
TERMINAL = "terminal_id"

#: column name per statistic; ``{}`` is the frame
CUSTOMER_COUNT = "avg_transaction_count_{}"
CUSTOMER_MEAN = "avg_transaction_mean_{}"
TERMINAL_COUNT = "avg_transaction_terminal_id_count_{}"

DAY = 86_400
#: seconds of a key that a task works out day frames of, and tasks at most (beyond, a task's sorts spill)
TASK_SECONDS = 100_000
MOST_TASKS = 100_000


def row_frame(keys: str | Sequence[str], n: int) -> WindowSpec:
    """The current row and the ``n`` before it, in time order per key.

    ``transaction_id`` breaks ties in time, so the frame is the same every run.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return Window.partitionBy(*keys).orderBy(TIME, ID).rowsBetween(-n, 0)


def _position() -> Column:
    """Microseconds for slicing; rows without a time sort first, as they do in a window."""
    return F.coalesce(epoch_micros(TIME), F.lit(-(2**61)))


def _row_windows(
    df: DataFrame,
    wanted: dict[str, dict[str, str]],
    frames: Sequence[int],
    hot_rows: int | None,
    earlier: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Row-frame statistics for several keys.

    ``wanted`` maps a key column to ``{"count": name, "mean": name}``.  Each key
    costs one exchange.  A key value with more than ``hot_rows`` rows is cut into
    slices; each slice brings along the rows just before it, so frames that reach
    back over a cut stay whole.  ``earlier`` holds, per key column, rows that come
    before those of ``df`` and count in their frames only.
    """
    earlier = earlier or {}
    out = [*df.columns]
    rows = df.withColumn("_at", _position())
    before = {key: e.select(key, TIME, ID, AMOUNT).withColumn("_at", _position()) for key, e in earlier.items()}
    narrow = {key: rows.select(key, "_at", TIME, ID, AMOUNT) for key in wanted}
    narrow = {key: n.unionByName(before[key]) if key in before else n for key, n in narrow.items()}
    limits = {} if hot_rows is None else hot_limits(narrow, hot_rows)
    for key, stats in wanted.items():
        extra = [before[key]] if key in before else []
        cuts = hot_slices(narrow[key], key, "_at", ID, limits[key]) if key in limits else []
        names = slice_names(key, len(cuts))
        if cuts:
            rows = apply_slices(rows, key, "_at", ID, cuts)
            extra = [apply_slices(e, key, "_at", ID, cuts) for e in extra]
            hot = apply_slices(rows_of_hot_keys(narrow[key], key, cuts[0]), key, "_at", ID, cuts)
            extra.append(lead_in(hot, key, names, [TIME, ID], [AMOUNT], max(frames)))
        if extra:
            rows = rows.withColumn("_extra", F.lit(False))
            for e in extra:
                rows = rows.unionByName(e.withColumn("_extra", F.lit(True)), allowMissingColumns=True)
        columns = {}
        for n in frames:
            frame = row_frame([key, *names], n)
            if "count" in stats:
                columns[stats["count"].format(n)] = F.count(ID).over(frame).cast("float")
            if "mean" in stats:
                columns[stats["mean"].format(n)] = F.avg(AMOUNT).over(frame)
        rows = rows.withColumns(columns)
        if extra:
            rows = rows.filter(~F.col("_extra")).drop("_extra", *names)
        out += list(columns)
    return rows.select(*out)


def _day_windows(df: DataFrame, wanted: dict[str, dict[str, str]], frames: Sequence[int]) -> DataFrame:
    """Day-frame statistics: rows of the same key at most ``n * 86400`` seconds back.

    All rows of a key in one second share a frame, so frames are worked out per key
    and second and joined back.  However many rows a key or a second has, they are
    counted up before the shuffle.
    """
    out = [*df.columns]
    rows = df.withColumn("_sec", epoch_seconds(TIME))
    base = rows
    # seconds of each key, of which every task gets so many, however large the table
    seconds = base.agg(*[F.approx_count_distinct(F.struct(key, "_sec")).alias(key) for key in wanted]).first()
    for key, stats in wanted.items():
        tasks = min(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), seconds[key] // TASK_SECONDS + 1), MOST_TASKS)
        sums = _frames_by_second(base.select(key, "_sec", ID, AMOUNT), key, stats, frames, tasks)
        sums = sums.withColumnsRenamed({key: "_key", "_sec": "_at"})
        same = rows[key].eqNullSafe(sums["_key"]) & rows["_sec"].eqNullSafe(sums["_at"])
        rows = rows.join(sums, same, "left").drop("_key", "_at")
        out += [stats[s].format(n) for n in frames for s in ("count", "mean") if s in stats]
    return rows.select(*out)


def _frames_by_second(base: DataFrame, key: str, stats: dict[str, str], frames: Sequence[int], tasks: int) -> DataFrame:
    """Statistics of the frames that end in each second of each key.

    A sliding range frame would visit every second of 30 days for every second.
    Instead a frame is put together from three sums: this day so far, the days
    between, and the rest of the day the frame starts in (a running sum from its end).
    Nothing is taken away again, so amounts outside a frame, however large, leave its mean alone.

    A second goes to its own day and to the days whose frames start in it; the days between are summed from one row per day and
    join them there.  A window partition is one day of a key, which has 86,400 seconds at most, and tasks are ranges of keys and days of
    about the same size, so a hot key is cut between its days.
    """
    # what is added up: per statistic a value for each row
    parts = {"n": F.count(ID)} if "count" in stats else {}
    if "mean" in stats:
        parts |= {"priced": F.count(AMOUNT), "sum": F.coalesce(F.sum(AMOUNT), F.lit(0.0))}
    seconds = base.groupBy(key, "_sec").agg(*[v.alias(p) for p, v in parts.items()])
    seconds = seconds.withColumn("_day", F.floor(F.col("_sec") / DAY).cast("long"))

    # sums over the days that lie whole in a frame, one row per day; no column or row is left out here, so that both uses of ``seconds`` share its exchange
    by_day = Window.partitionBy(key).orderBy("_day")
    totals = seconds.repartition(key).groupBy(key, "_day").agg(F.min("_sec").alias("_sec"), *[F.sum(p).alias(p) for p in parts])
    dated = F.col("_day").isNotNull()
    between = {f"{p}_{n}": F.when(dated, F.sum(p).over(by_day.rangeBetween(1 - n, -1))) for n in frames if n > 1 for p in parts}
    covered = totals.select(key, "_day", "_sec", *[c.alias(name) for name, c in between.items()]).withColumn("_age", F.lit(-1))

    # each second also counts in the day whose frames start in its own day
    aged = seconds.withColumn("_age", F.explode(F.array(F.lit(0), *[F.lit(n) for n in frames])))
    aged = aged.withColumn("_day", F.col("_day") + F.col("_age"))
    aged = aged.where((F.col("_age") == 0) | F.col("_sec").isNotNull())
    rows = aged.unionByName(covered, allowMissingColumns=True).repartitionByRange(tasks, key, "_day")

    in_day = Window.partitionBy(key, "_day")
    moment = F.col("_sec") + F.col("_age") * DAY
    # the row of whole days comes first
    so_far = in_day.orderBy(moment).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    from_here = in_day.orderBy(moment.desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def running(age: int, part: str, frame: WindowSpec) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_age") == age, F.col(part))).over(frame), F.lit(0))

    def whole_days(part: str, n: int) -> Column:
        return F.coalesce(F.max(f"{part}_{n}").over(so_far), F.lit(0)) if n > 1 else F.lit(0)

    sums = {f"_{p}_{n}": running(0, p, so_far) + whole_days(p, n) + running(n, p, from_here) for n in frames for p in parts}
    named = {}
    for n in frames:
        if "count" in stats:
            named[stats["count"].format(n)] = F.col(f"_n_{n}").cast("float")
        if "mean" in stats:
            named[stats["mean"].format(n)] = F.try_divide(F.col(f"_sum_{n}"), F.col(f"_priced_{n}"))
    done = rows.withColumns(sums).filter(F.col("_age") == 0).withColumns(named)
    return done.select(key, "_sec", *named)


def last_rows(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The last ``n`` rows of each key, as far as later frames need them; cut before the shuffle."""
    newest = Window.partitionBy(key).orderBy(F.col(TIME).desc(), F.col(ID).desc())
    ranked = rows.select(key, TIME, ID, AMOUNT).withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def _wanted() -> dict[str, dict[str, str]]:
    return {
        CUSTOMER: {"count": CUSTOMER_COUNT, "mean": CUSTOMER_MEAN},
        TERMINAL: {"count": TERMINAL_COUNT},
    }


def _rolling(df, wanted, frames, frames_by, hot_rows):
    if frames_by not in ("rows", "days"):
        raise ValueError("frames_by is 'rows' or 'days'")
    if frames_by == "days":
        return _day_windows(df, wanted, frames)
    return _row_windows(df, wanted, frames, hot_rows)


def rolling_count(
    df: DataFrame,
    key: str,
    name: str = CUSTOMER_COUNT,
    frames: Sequence[int] = FRAMES,
    frames_by: str = "rows",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Transactions in each frame of ``key`` as FLOAT; ``{}`` in ``name`` is the frame."""
    return _rolling(df, {key: {"count": name}}, frames, frames_by, hot_rows)


def rolling_mean(
    df: DataFrame,
    key: str,
    name: str = CUSTOMER_MEAN,
    frames: Sequence[int] = FRAMES,
    frames_by: str = "rows",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Mean amount in each frame of ``key``."""
    return _rolling(df, {key: {"mean": name}}, frames, frames_by, hot_rows)


def rolling_features(
    df: DataFrame,
    frames: Sequence[int] = FRAMES,
    frames_by: str = "rows",
    hot_rows: int | None = HOT_ROWS,
    earlier: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Count and mean per customer, and count per terminal, over each frame.

    ``frames_by="rows"`` takes the current row and ``n`` before it;
    ``frames_by="days"`` takes everything up to ``n`` days back.  ``hot_rows`` is the
    number of rows above which row frames of one customer or terminal are cut into
    several window partitions; None never cuts.  ``earlier`` gives, for row frames and per key
    column, the :func:`last_rows` of what came before ``df``.
    """
    if earlier and frames_by == "rows":
        return _row_windows(df, _wanted(), frames, hot_rows, earlier)
    return _rolling(df, _wanted(), frames, frames_by, hot_rows)


def to_epoch(df: DataFrame, column: str = TIME) -> DataFrame:
    """Replace a timestamp by whole seconds since 1970."""
    return df.withColumn(column, epoch_seconds(column))


def to_feature_table(df: DataFrame) -> DataFrame:
    """Drop what must not reach a model (identifiers, the scenario) and encode the time."""
    return to_epoch(df.drop(*FEATURE_DROPS))


def feature_table(df: DataFrame, frames_by: str = "rows", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """The feature table of clean transactions; rows without a date are left out."""
    dated = df.filter(F.col(TIME).isNotNull())
    return to_feature_table(rolling_features(dated, frames_by=frames_by, hot_rows=hot_rows)).select(*FEATURES.names)
