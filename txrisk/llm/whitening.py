"""Whitening of embeddings by their leading principal components, found by block Jacobi-Davidson.

The covariance is never formed.  Its product with a block of vectors is one Spark job over all rows: each task
centres its rows, multiplies them with the block and that with the rows again, and Spark adds up the partial sums
by entry.  Only blocks as wide as a vector is long leave the cluster.  The subspace grows by
corrections for all pairs that have not converged; a correction solves the projected equation
``(I - QQ')(V - theta)(I - QQ') t = -r`` by a few steps of MINRES, all pairs in the same
job per step.  Rayleigh-Ritz in the subspace gives the next pairs; pairs whose residual is down to
double precision are locked, and the end is checked with fresh products.

Rows are whole numbers ``floor(scale * c) + shift``, stored once in packed blocks.  Sums are exact, and centring
takes off the whole part of the mean in whole numbers before its fraction, so nothing cancels.

A row counts if its vector is not null, has no null or non-finite entry, none of 2**40 or more in size (so sums stay
exact), and as many entries as most rows have (of ties, the most entries); other rows are left out.  An id may be null or
repeated; each row is one of its own.  Components with no variance (up to 1e-12 of the trace) are left out, so equal
rows, or none, give an empty result.  ``deviation`` is null where it is beyond a long.  Columns besides the two
named are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import batches_of, ddl, small_batches
from txrisk.session import settle

#: entries of a packed block (8 bytes each)
BLOCK_ENTRIES = 1 << 18
#: steps of MINRES for a correction
INNER = 3
#: the subspace is cut back to the best vectors once it is so many times as wide as what is asked for
WIDEST = 6
#: rounds after which the search ends if rounding keeps a residual above the goal
ROUNDS = 60
#: largest size of an entry
LARGEST = float(2**40)

PACKED = pa.schema([("ids", pa.list_(pa.int64())), ("rows", pa.binary())])
ENTRIES = pa.schema([("at", pa.int64()), ("value", pa.float64())])
SUMS = pa.schema([("at", pa.int64()), ("value", pa.int64())])
WHITE = pa.schema(
    [("id", pa.int64()), ("component", pa.int32()), ("deviation", pa.int64()), ("whitened", pa.float64())]
)


class Fit(NamedTuple):
    """What the rows have in common: the count, exact sums, and the components with their eigenvalues."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray


# -- rows in packed blocks ------------------------------------------------------


def _pack(batches: Iterable, width: int) -> Iterator[pa.RecordBatch]:
    most = max(1, BLOCK_ENTRIES // max(1, width))

    def blocks() -> Iterator[tuple]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            ids = batch.column(0).to_pylist()
            for at in range(0, len(ids), most):
                yield ids[at : at + most], np.ascontiguousarray(flat[at : at + most], "<i8").tobytes()

    yield from batches_of(blocks(), PACKED, flush=4)


def pack(rows: DataFrame, id_column: str, vector: str, scale: int, shift: int) -> tuple[DataFrame, int]:
    """The rows that count, as whole numbers in packed blocks, and how many entries a row has."""
    small_batches(rows.sparkSession)
    inside = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < LARGEST))
    valid = rows.where(F.col(vector).isNotNull() & inside)
    widths = valid.groupBy(F.size(vector).alias("width")).agg(F.count(F.lit(1)).alias("n"))
    most = widths.where("width > 0").orderBy(F.desc("n"), F.desc("width")).first()
    width = most["width"] if most else 0
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long") + shift)
    valid = valid.where(F.size(vector) == width).where(F.lit(width > 0)).select(F.col(id_column).cast("long").alias("id"), whole.alias("x"))
    return settle(valid.mapInArrow(partial(_pack, width=width), ddl(PACKED)), "blocks"), width


def _blocks(batches: Iterable, width: int) -> Iterator[tuple[list, np.ndarray]]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield batch.column("ids")[row].as_py(), np.frombuffer(batch.column("rows")[row].as_buffer(), "<i8").reshape(-1, width)


class Centre(NamedTuple):
    """The mean as a whole part and a fraction, for exact centring."""

    whole: np.ndarray
    fraction: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.fraction


def centre(n: int, sums: list[int]) -> Centre:
    whole = [s // n for s in sums]
    return Centre(np.array(whole, np.int64), np.array([(s - n * w) / n for s, w in zip(sums, whole, strict=True)]))


def _sums(batches: Iterable, width: int) -> Iterator[pa.RecordBatch]:
    total, n = [0] * width, 0
    for ids, x in _blocks(batches, width):
        n += len(ids)
        total = [a + b for a, b in zip(total, x.sum(axis=0).tolist(), strict=True)]
    yield from batches_of(enumerate([*total, n]), SUMS)


def count_and_sums(blocks: DataFrame, width: int) -> tuple[int, list[int]]:
    parts = blocks.mapInArrow(partial(_sums, width=width), ddl(SUMS))
    total = {r["at"]: int(r["value"]) for r in parts.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()}
    return total.get(width, 0), [total.get(k, 0) for k in range(width)]


def _added(blocks: DataFrame, step: Callable, shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all tasks of an array that ``step`` yields as ``(place, value)``."""
    out = np.zeros(int(np.prod(shape)))
    for r in blocks.mapInArrow(step, ddl(ENTRIES)).groupBy("at").agg(F.sum("value").alias("value")).collect():
        out[r["at"]] = r["value"]
    return out.reshape(shape)


def _entries(total: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    if total is not None:
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], schema=ENTRIES)


def _product(batches: Iterable, mean: Centre, block: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Centred rows times ``block``, and that with the centred rows again; the last column has the sums of squares."""
    total = None
    for _, x in _blocks(batches, len(block)):
        y = mean(x)
        own = np.concatenate([y.T @ (y @ block), (y * y).sum(axis=0)[:, None]], axis=1)
        total = own if total is None else total + own
    yield from _entries(total)


# -- eigenpairs -------------------------------------------------------------------


def orthonormal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """What ``new`` adds to ``basis``, as orthonormal columns; directions that add nothing are left out."""
    kept = basis
    for column in new.T:
        size = np.linalg.norm(column)
        for _ in range(3):
            column = column - kept @ (kept.T @ column)
        if size > 0 and np.linalg.norm(column) > 1e-10 * size:
            kept = np.concatenate([kept, (column / np.linalg.norm(column))[:, None]], axis=1)
    return kept[:, basis.shape[1] :]


def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of one symmetric system per column of ``rhs``; ``apply`` is called once a step."""
    eta = np.linalg.norm(rhs, axis=0)
    tiny = np.finfo(float).tiny

    def over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(np.abs(b) > tiny, a / np.where(np.abs(b) > tiny, b, 1.0), 0.0)

    v, v_old = over(rhs, eta), np.zeros_like(rhs)
    x, d, d_old = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    c = c_old = np.ones(rhs.shape[1])
    s = s_old = beta = np.zeros(rhs.shape[1])
    for _ in range(steps):
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_old
        beta_new = np.linalg.norm(p, axis=0)
        diagonal = c * alpha - c_old * s * beta
        length = np.hypot(diagonal, beta_new)
        upper, upper2 = s * alpha + c_old * c * beta, s_old * beta
        c_old, s_old = c, s
        c, s = over(diagonal, length), over(beta_new, length)
        d, d_old = over(v - upper2 * d_old - upper * d, length), d
        x = x + c * eta * d
        eta = -s * eta
        v, v_old, beta = over(p, beta_new), v, beta_new
    return x


def jacobi_davidson(
    product: Callable[[np.ndarray], np.ndarray], width: int, pairs: int, inner: int = INNER, rounds: int = ROUNDS, seed: int = 47
) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their vectors of a positive semi-definite matrix that only ``product`` knows."""
    pairs = min(pairs, width)
    nothing = np.zeros((width, 0))
    basis = orthonormal(np.random.default_rng(seed).standard_normal((width, min(width, 2 * pairs))), nothing)
    image = product(basis)
    checked, least, stuck = False, np.inf, 0
    for _ in range(rounds):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        ritz = basis @ turn[:, :pairs]
        residual = image @ turn[:, :pairs] - ritz * theta[:pairs]
        size = np.linalg.norm(residual, axis=0)
        goal = 8 * np.finfo(float).eps * np.sqrt(width) * max(theta[0], np.finfo(float).tiny)
        worst = float(size.max())
        stuck = 0 if worst < least / 2 else stuck + 1
        least = min(least, worst)
        # rounding of the products may keep a residual a little above the goal for good
        done = worst <= goal or (stuck >= 3 and worst <= 1000 * goal)
        if basis.shape[1] == width or (done and checked):
            break
        checked = done
        if done or basis.shape[1] >= min(width, WIDEST * pairs):
            # the pairs alone, to check them with new products, or with some in reserve, to go on with
            basis = orthonormal(ritz if done else basis @ turn[:, : 2 * pairs], nothing)
            image = product(basis)
            continue
        open_ = size > goal  # the others are locked: corrections are kept away from all pairs
        at = theta[:pairs][open_]

        def apply(t: np.ndarray, q: np.ndarray = ritz, at: np.ndarray = at) -> np.ndarray:
            t = t - q @ (q.T @ t)
            out = product(t) - t * at
            return out - q @ (q.T @ out)

        wanted = -residual[:, open_]
        new = orthonormal(minres(apply, wanted - ritz @ (ritz.T @ wanted), inner), basis)
        if new.shape[1]:
            basis, image = np.concatenate([basis, new], axis=1), np.concatenate([image, product(new)], axis=1)
    return theta[:pairs], ritz


def fit(blocks: DataFrame, width: int, components: int = 8) -> Fit:
    """Count, sums and leading components of the packed rows."""
    n, sums = count_and_sums(blocks, width) if width else (0, [])
    if not n:
        return Fit(0, sums, 0.0, np.zeros(0), np.zeros((width, 0)))
    mean, squares = centre(n, sums), []

    def product(block: np.ndarray) -> np.ndarray:
        out = _added(blocks, partial(_product, mean=mean, block=block), (width, block.shape[1] + 1)) / n
        squares.append(out[:, -1].sum())
        return out[:, :-1]

    values, vectors = jacobi_davidson(product, width, components)
    trace = float(squares[0])
    real = values > 1e-12 * trace
    return Fit(n, sums, trace, values[real], vectors[:, real])


# -- whitened rows ------------------------------------------------------------------


def _white(y: np.ndarray, fitted: Fit) -> np.ndarray:
    return (y @ fitted.vectors) / np.sqrt(fitted.values)


def _white_sums(batches: Iterable, fitted: Fit, mean: Centre, about: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of the whitened values, and of their products about ``about``."""
    total = None
    for _, x in _blocks(batches, len(fitted.sums)):
        w = _white(mean(x), fitted)
        own = np.concatenate([w.sum(axis=0)[None, :], (w - about).T @ (w - about)])
        total = own if total is None else total + own
    yield from _entries(total)


def identity_error(blocks: DataFrame, fitted: Fit) -> float:
    """The largest entry, without sign, of the whitened rows' covariance minus the identity."""
    k = len(fitted.values)
    mean = centre(fitted.n, fitted.sums)
    about = _added(blocks, partial(_white_sums, fitted=fitted, mean=mean, about=np.zeros(k)), (k + 1, k))[0] / fitted.n
    second = _added(blocks, partial(_white_sums, fitted=fitted, mean=mean, about=about), (k + 1, k))[1:] / fitted.n
    return float(np.abs(second - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: list[int], mean: Centre) -> list[int | None]:
    """Exact sums over the entries of ``(n * x - sum)**2``; None beyond a long."""
    off = x - mean.whole
    rest = [s - n * int(w) for s, w in zip(sums, mean.whole.tolist(), strict=True)]
    largest = (int(np.abs(off).max()) + 1) * n
    if largest * largest * len(sums) < 1 << 62:
        scaled = n * off - np.array(rest, np.int64)
        return (scaled * scaled).sum(axis=1).tolist()
    exact = [sum((n * a - r) ** 2 for a, r in zip(row, rest, strict=True)) for row in off.tolist()]
    return [d if d < 1 << 63 else None for d in exact]


def _whitened(batches: Iterable, fitted: Fit) -> Iterator[pa.RecordBatch]:
    mean, k = centre(fitted.n, fitted.sums), len(fitted.values)
    for ids, x in _blocks(batches, len(fitted.sums)):
        far = _deviations(x, fitted.n, fitted.sums, mean)
        columns = [
            pa.array([i for i in ids for _ in range(k)], pa.int64()),
            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(ids))),
            pa.array([d for d in far for _ in range(k)], pa.int64()),
            pa.array(_white(mean(x), fitted).ravel()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=WHITE)


def whiten(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = 8, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """``(<id>, component, n, deviation, whitened, explained, identity_error)`` per row that counts and component."""
    blocks, width = pack(rows, id_column, vector, scale, shift)
    fitted = fit(blocks, width, components)
    if not len(fitted.values):
        empty = ddl(WHITE).replace("`id`", f"`{id_column}`")
        return rows.sparkSession.createDataFrame([], empty).select(
            id_column, "component", F.lit(0).cast("long").alias("n"), "deviation", "whitened",
            F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error"),
        )
    shares = F.array(*[F.lit(float(e / fitted.trace)) for e in fitted.values])
    return blocks.mapInArrow(partial(_whitened, fitted=fitted), ddl(WHITE)).select(
        F.col("id").alias(id_column),
        "component",
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("component") - 1].alias("explained"),
        F.lit(identity_error(blocks, fitted)).alias("identity_error"),
    )
