"""Document fingerprints by locally consistent parsing.

On each level the symbols of a text are cut to phrases by deterministic coin tossing: a symbol is
compared with the one before it, and the lowest bit in which they differ, with its value, is
its label; a few rounds leave at most six labels, and a phrase begins at each local maximum.  Where
it begins depends on a few neighbours only, so equal substrings fall into equal phrases
but for their ends, wherever they stand.  A phrase is named by a hash of its symbols, and the names
are the symbols of the next level.  Runs of one symbol are a symbol of their own.

A fingerprint is a MinHash of the names on levels ``FIRST`` to ``LAST`` (of lower ones too, where a text
has few phrases there), ``SLOTS`` values of 32 bits in hex.  Likeness is the share of equal slots.
Null texts are empty; an empty text has the fingerprint of zeros, like only another one.  Any
surrogate a text could hold is one code point like others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import batches_of, ddl, rows_of, small_batches, texts

#: levels whose names are fingerprinted
FIRST, LAST = 2, 4
#: with fewer phrases on the first of them, a text's lower levels count too
FEW = 8
SLOTS = 96
#: texts of a batch are parsed together up to so many code points
TOGETHER = 1 << 17
#: ranges of ids, each one small row on the driver
MOST_RANGES = 4096

_A, _B, _C, _D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
#: what a place in a phrase adds; phrases are far shorter
_STEPS = np.arange(1 << 16, dtype=np.uint64) * _B
#: label of the mark before each text; no other symbol has it
_MARK = 127

FINGERPRINTS = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _D
    return (x ^ (x >> np.uint64(29))) * _C


#: a de Bruijn sequence: multiplied by a power of two, its upper six bits tell which
_BRUIJN = np.uint64(0x03F79D71B4CB0A89)
_PLACES = np.zeros(64, np.uint8)
_PLACES[[(0x03F79D71B4CB0A89 << i & 0xFFFFFFFFFFFFFFFF) >> 58 for i in range(64)]] = np.arange(64)


def _tossed(symbols: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Twice the place of the lowest bit in which neighbours differ, plus its value."""
    low = symbols ^ before
    low &= -low
    place = _PLACES.take(((low.view(np.uint64) * _BRUIJN) >> np.uint64(58)).view(np.int64))
    return 2 * place + ((symbols & low) != 0)


#: the second and later rounds work on labels below 128, so a table holds all of them
_ROUND = np.zeros(1 << 14, np.uint8)
_new, _old = (x.ravel() for x in np.meshgrid(np.arange(128), np.arange(128), indexing="ij"))
_ROUND[_new != _old] = _tossed(_new[_new != _old].astype(np.int64), _old[_new != _old].astype(np.int64))


def cuts(symbols: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Where phrases begin.  Neighbours differ; ``marks`` are the places of the marks before texts."""
    n = len(symbols)
    labels = np.empty(n, np.uint8)
    labels[0] = _MARK
    # 62 bits of the symbols, so that labels stay below the mark's
    x = (symbols & np.uint64((1 << 62) - 1)).view(np.int64)
    labels[1:] = _tossed(x[1:], x[:-1])  # two marks in a row have no difference, but get their label next
    labels[marks] = _MARK
    for _ in range(3):
        labels[1:] = _ROUND.take((labels[1:].astype(np.uint16) << 7) | labels[:-1])
        labels[marks] = _MARK
    begin = np.zeros(n, bool)
    begin[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    begin[marks] = True
    after = marks + 1
    begin[after[after < n]] = True  # the mark is a phrase of its own
    return np.flatnonzero(begin)


def _runs(symbols: np.ndarray) -> np.ndarray:
    """One symbol for each run of equal ones."""
    starts = np.concatenate(([True], symbols[1:] != symbols[:-1]))
    starts |= symbols == 0
    first = np.flatnonzero(starts)
    if len(first) == len(symbols):
        return symbols
    length = np.diff(np.append(first, len(symbols))).astype(np.uint64)
    out = symbols[first]
    long = length > 1
    out[long] = _mixed(out[long] * _A + length[long])
    return out


def levels(strings: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each level from 1 on, the names of all texts' phrases and which text each is of.

    Texts are parsed side by side; a mark before each keeps them apart.
    """
    sizes = np.array([len(s) for s in strings])
    symbols = np.zeros(sizes.sum() + len(strings), np.uint64)
    inside = np.ones(len(symbols), bool)
    inside[np.cumsum(sizes + 1) - sizes - 1] = False
    symbols[inside] = _mixed(np.concatenate(strings).astype(np.uint64) * _A + _B)
    while True:
        symbols = _runs(symbols)
        begin = cuts(symbols, np.flatnonzero(symbols == 0))
        # a phrase's name: a sum of its symbols, each mixed with its place in the phrase
        size = np.diff(np.append(begin, len(symbols)))
        place = np.arange(len(symbols), dtype=np.int32) - np.repeat(begin.astype(np.int32), size)
        terms = _mixed(symbols + _STEPS.take(place & 0xFFFF))
        names = _mixed(np.add.reduceat(terms, begin) + size.astype(np.uint64) * _A)
        names[symbols[begin] == 0] = 0
        symbols = names
        inside = symbols != 0
        if not inside.any():
            return
        yield symbols[inside], (np.cumsum(~inside) - 1)[inside]


def sketches(strings: list[np.ndarray]) -> np.ndarray:
    """One row of ``SLOTS`` values for each text."""
    out = np.full((len(strings), SLOTS), np.iinfo(np.uint32).max, np.uint32)
    whole = np.zeros(len(strings), bool)  # the text is one phrase: it has no further level
    low: list[tuple[np.ndarray, np.ndarray]] = []
    few = np.ones(len(strings), bool)
    for level, (names, doc) in enumerate(levels(strings), 1):
        own = ~whole[doc]
        names, doc = names[own], doc[own]
        count = np.bincount(doc, minlength=len(strings))
        if level == FIRST:
            few = count < FEW
        if level < FIRST:
            low.append((names, doc))
        else:
            _put(out, names, doc)
        whole |= count <= 1
        if level == LAST or whole.all():
            break
    for names, doc in low:  # texts of few phrases are told by their lower levels too
        take = few[doc]
        _put(out, names[take], doc[take])
    some = np.array([len(s) > 0 for s in strings], bool)
    out[~some] = 0
    return _dense(out, some)


def _put(out: np.ndarray, names: np.ndarray, doc: np.ndarray) -> None:
    """A name goes to one slot, where the smallest value stays."""
    h = _mixed(names * _B)
    slot = (h >> np.uint64(32)) * np.uint64(SLOTS) >> np.uint64(32)
    np.minimum.at(out.reshape(-1), doc * SLOTS + slot.astype(np.int64), (h & np.uint64(0xFFFFFFFF)).astype(np.uint32))


def _dense(out: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Fill empty slots from the slots of a fixed sequence, so that sketches of few names compare."""
    empty = out == np.iinfo(np.uint32).max
    turn = 1
    while True:
        rows = np.flatnonzero(some & empty.any(1) & ~empty.all(1))
        if not len(rows):
            return out
        order = (np.arange(SLOTS) * 37 + turn * 41) % SLOTS
        sub, gap = out[rows], empty[rows]
        take = gap & ~gap[:, order]
        mixed = (sub[:, order].astype(np.uint64) * _A + np.uint64(turn)) >> np.uint64(32)
        sub[take] = mixed.astype(np.uint32)[take]
        out[rows] = sub
        empty[rows] = gap & ~take
        turn += 1


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def fingerprint_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """The share of equal slots of two fingerprints."""
    x, y = (np.frombuffer(bytes.fromhex(s), ">u4") for s in (a, b))
    return float((x == y).mean())


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the beginning of the text that follows."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _fingerprint(batches: Iterable) -> Iterator[pa.RecordBatch]:
    """Rows come by range, those of the range first and then the text that follows them."""

    def told(block: list[tuple]) -> Iterator[tuple]:
        # (range, doc_id, text); the last one only follows
        pairs = [(x, y) for x, y in zip(block, block[1:]) if x[0] == y[0]]
        if not pairs:
            return
        changed = [edited(x[2], y[2]) for x, y in pairs]
        own = sketches([points(x[2]) for x in block])
        place = {id(x): k for k, x in enumerate(block)}
        other = sketches([points(t) for t in changed])
        for k, (x, y) in enumerate(pairs):
            a, b, c = own[place[id(x)]], other[k], own[place[id(y)]]
            sha = hashlib.sha256(changed[k].encode("utf-8", "surrogatepass")).hexdigest()
            yield x[1], len(x[2]), sha, fingerprint_text(a), fingerprint_text(b), float((a == b).mean()), float((a == c).mean())

    def rows() -> Iterator[tuple]:
        block: list[tuple] = []
        held = 0
        followed = None
        for part, follows, doc_id, text in rows_of(batches):
            if follows and part == followed:
                continue  # of several first rows with one id, the first follows
            followed = part if follows else followed
            block.append((part, doc_id, text))
            held += len(text)
            if held >= TOGETHER and len(block) > 1:
                yield from told(block)
                block, held = block[-1:], len(text)
        yield from told(block)

    yield from batches_of(rows(), FINGERPRINTS, flush=512)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text (see :func:`edited`), in ``doc_id`` order.

    The table is cut to ranges of ids; each range also gets the first row of the next one, and the last
    range the first of all, so no task needs another's rows and a text moves once.  Rows with equal
    ids are in order of their texts, rows without an id come first.
    """
    spark = docs.sparkSession
    small_batches(spark)
    plain = texts(docs)
    tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(2 * tasks, MOST_RANGES)
    found = plain.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10_000)).first()[0]
    bounds = sorted(set(found or []))
    part = F.coalesce(F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col("doc_id"))), F.lit(0)) if bounds else F.lit(0)
    least = F.min(F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id"))
    starts = plain.groupBy(part.alias("part")).agg(least.alias("least")).orderBy("part").collect()  # a row per range
    table = spark.createDataFrame(
        [(r.part, r.least.doc_id, starts[k - 1].part) for k, r in enumerate(starts)], "part int, first long, previous int"
    )
    here, before = (F.struct(p.cast("int").alias("part"), F.lit(f).alias("follows")) for p, f in ((F.col("part"), 0), (F.col("previous"), 1)))
    to = F.when(F.col("doc_id").eqNullSafe(F.col("first")), F.array(here, before)).otherwise(F.array(here))
    dealt = plain.withColumn("part", part).join(F.broadcast(table), "part").select("doc_id", "text", F.explode(to).alias("to"))
    ordered = dealt.select("to.part", "to.follows", "doc_id", "text").repartition(tasks, "part")
    return ordered.sortWithinPartitions("part", "follows", "doc_id", "text").mapInArrow(_fingerprint, ddl(FINGERPRINTS))
