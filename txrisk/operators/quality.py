"""Data quality: de-duplication, validity, dates, outlier fences and what each removed."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from fractions import Fraction
from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions import columns as fx
from txrisk.schema import IQR_COLUMNS, NON_NEGATIVE
from txrisk.session import settle

#: exact quantiles are read off directly once at most this many rows are left
EXACT_ROWS = 1_000_000

#: copies of one row that a single task writes out
COPIES_PER_TASK = 65_536


# -- duplicates ---------------------------------------------------------------


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None, keep: str = "first") -> DataFrame:
    """One row per key.

    ``keep="first"`` keeps the first row by ``order_by``, then by the remaining
    columns, so the survivor does not depend on the layout.  Every task cuts its
    rows to one per key before the shuffle, so a key with very many copies costs no
    more than any other.  ``keep="any"`` leaves the choice to Spark.
    """
    if keep == "any":
        return df.dropDuplicates(list(keys))
    if keep != "first":
        raise ValueError("keep is 'first' or 'any'")
    order = list(order_by or [])
    order += [c for c in df.columns if c not in order and c not in keys]
    ranked = Window.partitionBy(*keys).orderBy(*(order or keys))
    return df.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") == 1).drop("_rank")


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key; remaining columns break ties."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in [*order, *rest]])
    return df.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") == 1).drop("_rank")


def diff_removed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of ``before`` that are not in ``after``, counted with their copies.

    The same rows as ``before.exceptAll(after)``.  Copies are netted as counts, and
    a row with many copies is written out by several tasks.
    """
    cols = before.columns
    sides = before.select(*cols, F.lit(1).alias("_n")).unionAll(after.select(*cols, F.lit(-1).alias("_n")))
    net = sides.groupBy(*cols).agg(F.sum("_n").alias("_n")).filter(F.col("_n") > 0)
    batches = F.expr(f"sequence(0L, (_n - 1) div {COPIES_PER_TASK})")
    here = F.least(F.lit(COPIES_PER_TASK), F.col("_n") - F.col("_batch") * COPIES_PER_TASK).cast("int")
    return (
        net.withColumn("_batch", F.explode(batches))
        .repartition(*cols, "_batch")
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), here)))
        .select(*cols)
    )


def duplicates(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """The rows :func:`dedup` removes."""
    return diff_removed(df, dedup(df, keys, order_by))


# -- validity and dates -------------------------------------------------------


def is_valid(columns: Sequence[str] = NON_NEGATIVE) -> Column:
    """All columns present and not negative (NULL if one is missing)."""
    return reduce(and_, [F.col(c) >= 0 for c in columns])


def drop_invalid(df: DataFrame, columns: Sequence[str] = NON_NEGATIVE) -> DataFrame:
    return df.filter(is_valid(columns))


def invalid_rows(df: DataFrame, columns: Sequence[str] = NON_NEGATIVE) -> DataFrame:
    """The rows :func:`drop_invalid` removes."""
    return df.filter(~F.coalesce(is_valid(columns), F.lit(False)))


def require_not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.filter(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def parse_datetime(df: DataFrame, column: str = "tx_datetime") -> DataFrame:
    """Turn text into timestamps; text in any other form becomes NULL."""
    return df.withColumn(column, fx.parse_datetime(column))


def is_bad_datetime(column: str = "tx_datetime") -> Column:
    return F.col(column).isNotNull() & fx.parse_datetime(column).isNull()


def bad_datetimes(df: DataFrame, column: str = "tx_datetime") -> DataFrame:
    """Rows whose date text does not parse."""
    return df.filter(is_bad_datetime(column))


def pseudonymise(df: DataFrame, columns: Sequence[str], salt: str) -> DataFrame:
    """Replace identifiers by salted hashes; equal identifiers stay equal."""
    return df.withColumns({c: fx.pseudonym(c, salt) for c in columns})


# -- quantiles and interquartile fences ---------------------------------------


class _Search:
    """One rank of one column, and the span of values it is known to be in."""

    def __init__(self, column: str, rank: int, low, high, held: int):
        self.value = F.col(column)
        self.column, self.rank, self.low, self.high, self.held = column, rank, low, high, held

    @property
    def settled(self) -> bool:
        return self.low == self.high or self.held <= EXACT_ROWS

    def inside(self) -> Column:
        return self.value.between(F.lit(self.low), F.lit(self.high))


def _one(df: DataFrame, columns: Sequence[Column]) -> list:
    """One pass over ``df``."""
    return list(df.agg(*[c.alias(f"_{i}") for i, c in enumerate(columns)]).first())


def _exact_quantiles(df: DataFrame, columns: Sequence[str], qs: Sequence[float], at_most: int | None = None) -> dict[str, list]:
    """Per column and share ``q``, the smallest value with at least that share of the non-NULL values up to it.

    All columns and shares are searched for together.  A round brackets every rank that is still open by approximate
    quantiles (one pass), counts all brackets (one pass), and goes on inside them; a rank that its bracket misses, or
    does not narrow down, has its span of values halved (one pass for all of them).  Once no span has more than ``EXACT_ROWS`` rows, one pass
    reads off all values.  So the passes do not depend on how many columns and shares there are.  Values that are infinite or not
    a number are counted apart, as they have no middle.  ``at_most`` is a number of rows that ``df`` is known not to exceed.
    """
    columns = list(dict.fromkeys(columns))
    whole = [c for c in columns if dict(df.dtypes)[c] in ("tinyint", "smallint", "int", "bigint")]
    broken = [c for c in columns if dict(df.dtypes)[c] in ("float", "double")]
    df = df.select(*[F.col(c).cast("long" if c in whole else "double" if c in broken else dict(df.dtypes)[c]).alias(c) for c in columns])
    if at_most is not None and at_most <= EXACT_ROWS:
        return _read_off(df, {c: [(q, None) for q in qs] for c in columns})
    minus, plus, none = (F.lit(float(x)) for x in ("-inf", "inf", "nan"))
    stats = []
    for c in columns:
        v = F.col(c)
        odd = [F.count_if(v == x) for x in (minus, plus, none)] if c in broken else [F.lit(0)] * 3
        finite = F.when((v > minus) & (v < plus), v) if c in broken else v
        stats += [F.count(v), *odd, F.min(finite), F.max(finite)]
    told = _one(df, stats)
    found: dict[tuple[str, float], object] = {}
    searches: dict[tuple[str, float], _Search] = {}
    for i, c in enumerate(columns):
        n, n_minus, n_plus, n_none, low, high = told[6 * i : 6 * i + 6]
        for q in qs:
            rank = max(1, ceil(Fraction(str(q)) * n))
            if not n or rank <= n_minus:
                found[c, q] = float("-inf") if n else None
            elif rank > n - n_none:
                found[c, q] = float("nan")
            elif rank > n - n_none - n_plus:
                found[c, q] = float("inf")
            else:
                searches[c, q] = _Search(c, rank - n_minus, low, high, n - n_minus - n_plus - n_none)
    while open_ := [s for s in searches.values() if not s.settled]:
        _narrow(df, open_)
    for at, s in searches.items():
        if s.low == s.high:
            found[at] = s.low
    rest: dict[str, list] = {}
    for (c, q), s in searches.items():
        if s.low != s.high:
            rest.setdefault(c, []).append((q, s))
    if rest:
        picked = _read_off(df, rest)
        found |= {(c, q): v for c, asked in rest.items() for (q, _), v in zip(asked, picked[c], strict=True)}
    return {c: [found[c, q] for q in qs] for c in columns}


def _narrow(df: DataFrame, searches: Sequence[_Search]) -> None:
    """Narrow the span of every search, all of them in the same passes."""
    slack = 2e-4
    ends = _one(df, [F.percentile_approx(F.when(s.inside(), s.value), [max(0.0, s.rank / s.held - slack), min(1.0, s.rank / s.held + slack)], 10_000) for s in searches])
    counts = []
    for s, (low, high) in zip(searches, ends, strict=True):
        counts += [F.count_if(s.inside() & (s.value < F.lit(low))), F.count_if(s.value.between(F.lit(low), F.lit(high)))]
    told = _one(df, counts)
    missed = []
    for i, (s, (low, high)) in enumerate(zip(searches, ends, strict=True)):
        below, held = told[2 * i : 2 * i + 2]
        if below < s.rank <= below + held and held < s.held:
            s.low, s.high, s.rank, s.held = low, high, s.rank - below, held
        elif below < s.rank <= below + held and low == high:
            s.low, s.high = low, high
        else:
            missed.append(s)
    if missed:
        _halve(df, missed)


def _halve(df: DataFrame, searches: Sequence[_Search]) -> None:
    """Halve the span of values of every search in one pass, for data that a bracket does not cut."""
    asked = []
    for s in searches:
        middle = s.low + (s.high - s.low) // 2 if isinstance(s.low, int) else s.low / 2 + s.high / 2
        middle = s.low if middle >= s.high else middle
        low_side = s.inside() & (s.value <= F.lit(middle))
        high_side = s.inside() & (s.value > F.lit(middle))
        asked += [F.count_if(low_side), F.max(F.when(low_side, s.value)), F.min(F.when(high_side, s.value))]
    told = _one(df, asked)
    for i, s in enumerate(searches):
        upto, under, over = told[3 * i : 3 * i + 3]
        if upto >= s.rank:
            s.high, s.held = under, upto
        else:
            s.low, s.rank, s.held = over, s.rank - upto, s.held - upto


def _read_off(df: DataFrame, asked: dict[str, list]) -> dict[str, list]:
    """Values of the given ranks in one pass: per column, shares of all its rows, or searches among at most ``EXACT_ROWS`` rows each.

    Equal values of a search are counted before the shuffle, and each search has a window of its own.
    """
    places = [(c, q, s) for c, own in asked.items() for q, s in own]
    # shares of a whole column need its values only once
    groups = list(dict.fromkeys((c, None if s is None else i) for i, (c, _, s) in enumerate(places)))
    rows = []
    for g, (c, i) in enumerate(groups):
        s = None if i is None else places[i][2]
        value = F.col(c).isNotNull() if s is None else s.inside()
        kinds = [F.when(value, F.col(c)) if k == c else F.lit(None).cast(dict(df.dtypes)[k]) for k in asked]
        rows.append(F.when(value, F.struct(F.lit(g).alias("g"), *[x.alias(f"v{j}") for j, x in enumerate(kinds)])))
    counted = df.select(F.explode(F.array_compact(F.array(*rows))).alias("r")).select("r.*")
    names = [f"v{j}" for j in range(len(asked))]
    counted = counted.groupBy("g", *names).agg(F.count(F.lit(1)).alias("n"))
    one = Window.partitionBy("g")
    upto = F.sum("n").over(one.orderBy(*names))
    counted = counted.withColumns({"upto": upto, "n_all": F.sum("n").over(one)})
    wanted = []
    for i, (c, q, s) in enumerate(places):
        g = groups.index((c, None if s is None else i))
        rank = F.greatest(F.lit(1), F.ceil(F.lit(Decimal(str(q))) * F.col("n_all"))) if s is None else F.lit(s.rank)
        name = names[list(asked).index(c)]
        wanted.append(F.min(F.when((F.col("g") == g) & (F.col("upto") >= rank), F.col(name))))
    told = _one(counted, wanted)
    out: dict[str, list] = {c: [] for c in asked}
    for (c, _, _), v in zip(places, told, strict=True):
        out[c].append(v)
    return out


def _quantile_values(
    df: DataFrame, columns: Sequence[str], qs: Sequence[float], exact: bool, accuracy: int, at_most: int | None = None
) -> dict[str, list]:
    if exact:
        return _exact_quantiles(df, columns, qs, at_most)
    # every column in one pass, merged from fixed-size digests
    found = df.agg(*[F.percentile_approx(c, list(qs), accuracy).alias(c) for c in columns]).first()
    return {c: found[c] or [None] * len(qs) for c in columns}


def quantiles(
    df: DataFrame, columns: Sequence[str], qs: Sequence[float] = (0.25, 0.75), exact: bool = False, accuracy: int = 10_000
) -> DataFrame:
    """Quantiles as rows ``(column, q, value)``.

    Approximate ones (rank error up to ``1 / accuracy``) take one pass for all
    columns.  Exact ones take a few passes, whatever the number of columns and shares.
    """
    found = _quantile_values(df, columns, qs, exact, accuracy)
    rows = [(c, float(q), None if v is None else float(v)) for c in columns for q, v in zip(qs, found[c], strict=True)]
    return df.sparkSession.createDataFrame(rows, "column string, q double, value double")


def _fence(quartiles: Sequence, k: float) -> tuple[float, float]:
    q1, q3 = (float("nan") if v is None else float(v) for v in quartiles)
    return q1 - k * (q3 - q1), q3 + k * (q3 - q1)


def within(limits: dict[str, tuple[float, float]]) -> Column:
    return reduce(and_, [F.col(c).between(low, high) for c, (low, high) in limits.items()], F.lit(True))


def fences(
    df: DataFrame,
    columns: Sequence[str] = IQR_COLUMNS,
    k: float = 1.5,
    mode: str = "sequential",
    exact: bool = False,
    accuracy: int = 10_000,
) -> dict[str, tuple[float, float]]:
    """Lower and upper fence per column: the quartiles, ``k`` interquartile ranges further out.

    ``mode="sequential"`` takes the quartiles of a column over the rows that the
    columns before it kept, one pass per column.  ``mode="joint"`` takes all of them
    over all rows, in one pass.  Fences are literals, so they reach the scan.
    """
    if mode == "joint":
        found = _quantile_values(df, columns, (0.25, 0.75), exact, accuracy)
        return {c: _fence(found[c], k) for c in columns}
    if mode != "sequential":
        raise ValueError("mode is 'sequential' or 'joint'")
    result: dict[str, tuple[float, float]] = {}
    rows = df.count() if exact else None
    for c in columns:
        kept = df.filter(within(result)) if result else df
        result[c] = _fence(_quantile_values(kept, [c], (0.25, 0.75), exact, accuracy, rows)[c], k)
    return result


def iqr_bounds(df: DataFrame, columns: Sequence[str] = IQR_COLUMNS, k: float = 1.5, **options) -> DataFrame:
    """Fences as rows ``(column, lower, upper)``; ``options`` as in :func:`fences`."""
    rows = [(c, low, high) for c, (low, high) in fences(df, columns, k, **options).items()]
    return df.sparkSession.createDataFrame(rows, "column string, lower double, upper double")


def iqr_filter(df: DataFrame, columns: Sequence[str] = IQR_COLUMNS, k: float = 1.5, **options) -> DataFrame:
    """Rows inside the fences of every column; a NULL is outside."""
    return df.filter(within(fences(df, columns, k, **options)))


def outliers(df: DataFrame, columns: Sequence[str] = IQR_COLUMNS, k: float = 1.5, **options) -> DataFrame:
    """The rows :func:`iqr_filter` removes."""
    return df.filter(~F.coalesce(within(fences(df, columns, k, **options)), F.lit(False)))


# -- report -------------------------------------------------------------------


def report(
    raw: DataFrame,
    keys: Sequence[str] = ("transaction_id",),
    columns: Sequence[str] = NON_NEGATIVE,
    iqr_columns: Sequence[str] = IQR_COLUMNS,
    k: float = 1.5,
    **options,
) -> DataFrame:
    """What each cleaning rule removes from the rows the rules before it left.

    Rows ``(step, rule, rows_in, rows_removed)``.  A bad date is blanked, not
    removed, so the outlier rule still sees its row.  What the counts and the fences
    need of the de-duplicated table is written once, since both read it.
    """
    valid = F.coalesce(is_valid(columns), F.lit(False))
    checked = dedup(raw, keys).select(*iqr_columns, valid.alias("_valid"), (valid & is_bad_datetime()).alias("_bad"))
    checked = settle(checked, "checked")
    inside = within(fences(checked.filter("_valid"), iqr_columns, k, **options))
    counts = checked.agg(
        F.count(F.lit(1)).alias("unique"),
        F.count_if("_valid").alias("valid"),
        F.count_if("_bad").alias("bad"),
        F.count_if(F.col("_valid") & ~F.coalesce(inside, F.lit(False))).alias("outside"),
    ).withColumn("raw", raw.agg(F.count(F.lit(1))).scalar())
    rules = [
        ("duplicates", F.col("raw"), F.col("raw") - F.col("unique")),
        ("invalid", F.col("unique"), F.col("unique") - F.col("valid")),
        ("bad_datetimes", F.col("valid"), F.col("bad")),
        ("outliers", F.col("valid"), F.col("outside")),
    ]
    lines = [
        F.struct(F.lit(i).alias("step"), F.lit(r).alias("rule"), a.alias("rows_in"), b.alias("rows_removed"))
        for i, (r, a, b) in enumerate(rules, 1)
    ]
    return counts.select(F.inline(F.array(*lines)))
