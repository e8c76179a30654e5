"""Token ids in grammar-compressed shards (Re-Pair), and their reading.

A shard is a run of whole documents in ascending ``doc_id`` order.  Its ids are one
sequence; frequent neighbouring pairs are replaced by new symbols, round after round, and
the rules with the length each symbol expands to are stored beside what is left, so any
range of ids is found by a search in the running lengths and only that range is expanded.

A stored table has one row per shard:

``part, shard``            the range of documents and the shard's number in it
``start_in_part, n_ids``   ids of the part before the shard, and in it
``doc_ids, doc_lengths``   the shard's documents and how many ids each has
``base``                   symbols from here on are rules, in the order of ``rules``
``rules``                  two little-endian unsigned 32-bit symbols a rule
``lengths``                the ids each rule expands to, the same integers
``width, sequence``        bytes per symbol (2 or 4) and the symbols that are left

Null texts are empty, and an empty text is a document with the end id alone.  Documents
with equal ids (or none: nulls come first) keep one order by text.  An empty table gives an
empty store.  Columns besides ``doc_id`` and ``text`` are not read.  Shards close after the
document that fills them, so a task holds one shard
and the texts that are encoded together (4 million characters and one text).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txrisk.llm.common import batches_of, ddl, rows_of, small_batches, texts
from txrisk.llm.tokens import encoder
from txrisk.session import settle

#: a shard is closed once it holds so many ids
SHARD_IDS = 1 << 18
#: rounds of replacement at most; each may build on the rules of those before, and a shard of copies halves with each
ROUNDS = 64
#: words and parts that a task remembers the ids of
MEMO = 800_000
#: texts of so many characters are encoded together
SLICE_CHARS = 4_000_000
#: tasks that wrote a store, up to which their starts are broadcast (16 bytes each)
PARTS = 200_000
#: a pair is replaced if it is found this often, which is when rule and length pay for themselves
LEAST = 6
#: a round that saves a smaller share is the last
LEAST_GAIN = 0.02

STORED = pa.schema(
    [("part", pa.int64()), ("shard", pa.int64()), ("start_in_part", pa.int64()), ("n_ids", pa.int64()),
     ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64())), ("base", pa.int64()),
     ("rules", pa.binary()), ("lengths", pa.binary()), ("width", pa.int32()), ("sequence", pa.binary())]
)
READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

PIECES = pa.schema([("request", pa.int64()), ("piece", pa.int64()), ("ids", pa.binary())])
#: ranges of one shard that go into a row; a shard that more are asked of is read by several tasks
PER_ROW = 1024

#: slots of the tables in which pairs are counted and looked up
SLOTS = 1 << 18


def _slots(pairs: np.ndarray) -> np.ndarray:
    return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).view(np.int64)


class Grammar(NamedTuple):
    base: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray
    sequence: np.ndarray


def compress(ids: np.ndarray, rounds: int = ROUNDS, least: int = LEAST) -> Grammar:
    """Replace frequent pairs of ``ids`` by rules.

    A round counts all pairs at once.  Where chosen pairs overlap, the more frequent one is
    replaced; the others wait for the next round.
    """
    seq = ids.astype(np.int64)
    base = int(seq.max()) + 1 if len(seq) else 0
    left, right, lengths = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    symbol = base
    for _ in range(rounds):
        if len(seq) < 2:
            break
        pairs = (seq[:-1] << 32) | seq[1:]
        slot = _slots(pairs)
        # a pair is no more frequent than its slot, so only those in full slots are counted exactly
        ordered = np.sort(pairs[np.bincount(slot, minlength=SLOTS)[slot] >= least])
        if not len(ordered):
            break
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        counts = np.diff(np.append(first, len(ordered)))
        often = counts >= least
        if not often.any():
            break
        chosen, counts = ordered[first[often]], counts[often]
        rising = np.argsort(counts, kind="stable")
        chosen = chosen[rising]
        table = np.zeros(SLOTS, np.int32)  # of pairs that share a slot, the most frequent is replaced
        table[_slots(chosen)] = np.arange(len(chosen), dtype=np.int32)
        at = table[slot]
        rank = np.where(chosen[at] == pairs, at, -1)
        best = rank >= 0
        best[1:] &= rank[1:] > rank[:-1]
        best[:-1] &= rank[:-1] >= rank[1:]
        used = np.bincount(at[best], minlength=len(chosen))
        best &= (used >= least)[at]
        pays = used >= least
        saved = int(used[pays].sum())
        if saved < LEAST_GAIN * len(seq):
            break
        number = np.cumsum(pays) - 1 + symbol
        chosen = chosen[pays]
        a, b = chosen >> 32, chosen & 0xFFFFFFFF
        known = np.concatenate(lengths)
        size = lambda x, known=known: np.where(x < base, 1, known[np.maximum(x - base, 0)] if len(known) else 1)
        left.append(a)
        right.append(b)
        lengths.append(size(a) + size(b))
        symbol += len(chosen)
        where = np.flatnonzero(best)
        seq[where] = number[at[where]]
        keep = np.ones(len(seq), bool)
        keep[where + 1] = False
        seq = seq[keep]
    return Grammar(base, np.concatenate(left), np.concatenate(right), np.concatenate(lengths), seq)


def expand(grammar: Grammar, sequence: np.ndarray | None = None) -> np.ndarray:
    """The ids of ``sequence`` (all of the grammar's if not given)."""
    seq = grammar.sequence if sequence is None else sequence
    while True:
        rule = seq >= grammar.base
        if not rule.any():
            return seq
        at = np.arange(len(seq)) + np.cumsum(rule) - rule
        out = np.empty(len(seq) + int(rule.sum()), np.int64)
        out[at] = seq
        out[at[rule]] = grammar.left[seq[rule] - grammar.base]
        out[at[rule] + 1] = grammar.right[seq[rule] - grammar.base]
        seq = out


def running_lengths(grammar: Grammar) -> np.ndarray:
    """The ids that the symbols of a sequence expand to, up to and with each of them."""
    sizes = np.ones(len(grammar.sequence), np.int64)
    rule = grammar.sequence >= grammar.base
    sizes[rule] = grammar.lengths[grammar.sequence[rule] - grammar.base]
    return np.cumsum(sizes)


def expand_range(grammar: Grammar, start: int, length: int, ends: np.ndarray | None = None) -> np.ndarray:
    """Ids ``start`` to ``start + length`` without expanding the others; ``ends`` are the running lengths, if they are known."""
    ends = running_lengths(grammar) if ends is None else ends
    first = int(np.searchsorted(ends, start, "right"))
    last = int(np.searchsorted(ends, start + length, "left"))
    skip = start - (int(ends[first - 1]) if first else 0)
    return expand(grammar, grammar.sequence[first : last + 1])[skip : skip + length]


def _stored(part: int, shard: int, start: int, docs: list[tuple[int, int]], ids: bytes, rounds: int) -> tuple:
    g = compress(np.frombuffer(ids, "<u4"), rounds)
    wide = g.base + len(g.left) > 1 << 16
    rules = np.stack([g.left, g.right], 1).astype("<u4").tobytes()
    sequence = g.sequence.astype("<u4" if wide else "<u2").tobytes()
    ids_of, lengths = [d for d, _ in docs], [n for _, n in docs]
    return part, shard, start, sum(lengths), ids_of, lengths, g.base, rules, g.lengths.astype("<u4").tobytes(), 4 if wide else 2, sequence


def grammar_of(base: int, rules: bytes, lengths: bytes, width: int, sequence: bytes) -> Grammar:
    """A stored shard's grammar."""
    pairs = np.frombuffer(rules, "<u4").reshape(-1, 2).astype(np.int64)
    sizes = np.frombuffer(lengths, "<u4").astype(np.int64)
    return Grammar(base, pairs[:, 0], pairs[:, 1], sizes, np.frombuffer(sequence, f"<u{width}").astype(np.int64))


def _slices(rows: Iterable[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    """Rows whose texts have ``SLICE_CHARS`` together, and at most one more."""
    held: list[tuple[int, str]] = []
    chars = 0
    for row in rows:
        held.append(row)
        chars += len(row[1] or "")
        if chars >= SLICE_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


def _write_shards(batches: Iterable, path: str, end_id: int, shard_ids: int, rounds: int) -> Iterator[pa.RecordBatch]:
    encode_all = encoder(path, MEMO).encode_all
    end = int(end_id).to_bytes(4, "little")
    part = TaskContext.get().partitionId()

    def encoded() -> Iterator[tuple[int, bytes]]:
        for rows in _slices(rows_of(batches)):
            ids, lengths = encode_all([text or "" for _, text in rows])
            stops = np.cumsum(lengths)
            for (doc_id, _), n, stop in zip(rows, lengths, stops, strict=True):
                yield doc_id, ids[stop - n : stop].tobytes() + end

    def shards() -> Iterator[tuple]:
        number = start = held = 0
        docs: list[tuple[int, int]] = []
        ids: list[bytes] = []
        for doc_id, own in encoded():
            docs.append((doc_id, len(own) // 4))
            ids.append(own)
            held += len(own) // 4
            if held >= shard_ids:
                yield _stored(part, number, start, docs, b"".join(ids), rounds)
                number, start, held, docs, ids = number + 1, start + held, 0, [], []
        if docs:
            yield _stored(part, number, start, docs, b"".join(ids), rounds)

    yield from batches_of(shards(), STORED, flush=8)


def write(docs: DataFrame, tokenizer: str, out: str, end_id: int = 2, shard_ids: int = SHARD_IDS, rounds: int = ROUNDS) -> None:
    """Encode ``docs`` and write their shards to ``out`` (any path Spark can write)."""
    small_batches(docs.sparkSession)
    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    step = partial(_write_shards, path=tokenizer, end_id=end_id, shard_ids=shard_ids, rounds=rounds)
    ordered.mapInArrow(step, ddl(STORED)).write.parquet(out)


def _read_shards(batches: Iterable) -> Iterator[pa.RecordBatch]:
    def docs() -> Iterator[tuple]:
        for ids_of, lengths, start, base, rules, sizes, width, sequence in rows_of(batches):
            ids = expand(grammar_of(base, rules, sizes, width, sequence)).astype("<u4")
            at = 0
            for doc_id, n in zip(ids_of, lengths, strict=True):
                yield doc_id, start + at, n, ids[at : at + n].tobytes()
                at += n

    yield from batches_of(docs(), READ, flush=256)


def starts(shards: DataFrame) -> DataFrame:
    """``(part, before)``: how many ids are before each part.  One row per task that wrote the store, so the ordered sum is small."""
    sums = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = settle(sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "parts")
    return F.broadcast(parts) if parts.count() <= PARTS else parts


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of a store: ids as bytes, ``start`` over the whole store."""
    small_batches(spark)
    shards = spark.read.parquet(path)
    return (
        shards.join(starts(shards), "part")
        .select("doc_ids", "doc_lengths", F.col("before") + F.col("start_in_part"), "base", "rules", "lengths", "width", "sequence")
        .mapInArrow(_read_shards, ddl(READ))
    )


def _read_ranges(batches: Iterable) -> Iterator[pa.RecordBatch]:
    """Each row is a shard with the ranges asked of it; only these are expanded."""

    def ranges() -> Iterator[tuple]:
        for asked, base, rules, sizes, width, sequence in rows_of(batches):
            grammar = grammar_of(base, rules, sizes, width, sequence)
            ends = running_lengths(grammar)
            for one in asked:
                ids = expand_range(grammar, one["skip"], one["take"], ends)
                yield one["request"], one["piece"], ids.astype("<u4").tobytes()

    yield from batches_of(ranges(), PIECES, flush=64)


def read_ranges(spark: SparkSession, path: str, requests: DataFrame) -> DataFrame:
    """``(request, start, length, ids)``: ids ``start`` to ``start + length`` of the whole store for each row of ``requests``.

    ``requests`` are ``(request, start, length)``; a request number may be repeated.  A range over several shards is put together from
    the pieces of each; what is beyond the end of the store is left out.  A shard that no range touches is not read beyond its numbers, and of the
    others only the symbols that overlap a range are expanded.
    """
    small_batches(spark)
    shards = spark.read.parquet(path)
    first = F.col("before") + F.col("start_in_part")
    places = settle(shards.join(starts(shards), "part").select("part", "shard", first.alias("first"), "n_ids"), "places")
    span = F.col("n_ids")
    size = places.agg(F.max(span)).first()[0] or 1
    # ranges and shards meet in cells as long as the longest shard, of which a shard touches two at most
    cells = lambda a, n: F.explode(F.sequence(F.floor(a / size), F.floor((a + F.greatest(n, F.lit(1)) - 1) / size)))
    wanted = requests.select(F.monotonically_increasing_id().alias("own"), "request", F.col("start").cast("long"), F.col("length").cast("long"))
    wanted = settle(wanted.where("start >= 0 and length > 0"), "requests")
    asked = wanted.select("own", "start", "length", cells(F.col("start"), F.col("length")).alias("cell"))
    met = places.select("*", cells(F.col("first"), span).alias("cell")).join(asked, "cell")
    low = F.greatest("first", "start")
    high = F.least(F.col("first") + span, F.col("start") + F.col("length"))
    met = met.where(low < high).select("part", "shard", "own", low.alias("low"), (low - F.col("first")).alias("skip"), (high - low).alias("take")).distinct()
    piece = F.struct(F.col("own").alias("request"), F.col("low").alias("piece"), "skip", "take")
    often = met.groupBy("part", "shard").agg(F.ceil(F.count(F.lit(1)) / PER_ROW).alias("slices"))
    met = met.join(often, ["part", "shard"])
    grouped = met.groupBy("part", "shard", F.pmod(F.xxhash64("own"), F.col("slices")).alias("slice")).agg(F.collect_list(piece).alias("asked"))
    touched = grouped.join(shards, ["part", "shard"]).select("asked", "base", "rules", "lengths", "width", "sequence")
    pieces = touched.mapInArrow(_read_ranges, ddl(PIECES))
    whole = pieces.groupBy("request").agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("pieces"))
    joined = wanted.join(whole, wanted["own"] == whole["request"], "left").select(wanted["request"], "start", "length", "pieces")
    ids = F.aggregate(F.coalesce(F.col("pieces.ids"), F.array().cast("array<binary>")), F.lit(b""), lambda s, x: F.concat(s, x))
    return joined.select("request", "start", "length", ids.alias("ids"))
