"""Spelling variants: words one code point apart, found by Bloom-guided neighbourhoods.

The vocabulary is counted by Spark.  Blocked Bloom filters of it, one per word length, are cut into segments of
bounded size; bundles of segments of at most ``BUNDLE_BYTES`` are broadcast one after the other, so a vocabulary of any size is
probed with bounded memory.  Each word generates the words one deletion shorter and those with one letter replaced
by a later one (insertions are deletions seen from the other word, earlier letters replacements seen from
it), as hashes that follow from the word's own in constant time.  Only hashes that the filter knows become
text and are shuffled to an exact join with the vocabulary, which removes what the filter let through by chance.

A null text has no words, a null id counts as empty text before the colon; empty texts and tables give no
words; repeated rows count as often as they are there.  Words may be of any length: neighbours are
generated in pieces of at most ``PIECE`` hashes.  The runs of one text are an array of its row, so a task holds
one text and its runs.  Columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import batches_of, ddl, lower_ascii, rows_of, small_batches
from txrisk.llm.shingles import mixed
from txrisk.session import settle

#: letters of words, as lower-cased: a to z, and the code points U+00C0 to U+00FF
RUN = "[a-zÀ-ÿ]+"

#: bits per word in a filter, of which each word sets one in every 32-bit lane of its block
BITS = 16
LANES = 8
BLOCK_WORDS = LANES * 32 // BITS
#: blocks of a segment (128 KB, for about 65,000 words)
SEGMENT = 4096
#: filters that are broadcast at once
BUNDLE_BYTES = 32 * 1024 * 1024
#: neighbours that are generated at once
PIECE = 1 << 20

_SALTS = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], np.uint32)
_PLACE, _LETTER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

CODED = pa.schema([("word", pa.string()), ("n", pa.int64()), ("length", pa.int64()), ("h", pa.int64())])
SEGMENTED = pa.schema([("length", pa.int64()), ("segment", pa.int64()), ("h", pa.int64())])
FILTERS = pa.schema([("length", pa.int64()), ("segment", pa.int64()), ("bits", pa.binary())])
POSITIVES = pa.schema([("word", pa.string()), ("n", pa.int64()), ("other", pa.string())])


def words(docs: DataFrame, drop_every: int | None = None) -> DataFrame:
    """A row ``word`` for each run of letters, A-Z in lower case.

    With ``drop_every``, a run loses one code point where that number divides the checksum of its document's id and
    itself: typing errors that are the same on every run of a job.
    """
    runs = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(RUN), F.lit(0))
    found = docs.select(F.col("doc_id").cast("long"), F.explode(runs).alias("run"))
    if not drop_every:
        return found.select(F.col("run").alias("word"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run"))
    found = found.select("run", h.alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    dropped = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    return found.select(F.when(F.col("h") % drop_every == 0, dropped).otherwise(F.col("run")).alias("word"))


def vocabulary(found: DataFrame, least_length: int = 5, least_times: int = 3) -> DataFrame:
    """``(word, n)`` of the words that are long and frequent enough."""
    counted = found.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_times)


# -- hashes of words and of their neighbours ----------------------------------


def _marks(codes: np.ndarray, first: int) -> np.ndarray:
    """A hash of each letter at its place; the columns of ``codes`` are places from ``first`` on."""
    places = np.arange(first, first + codes.shape[-1], dtype=np.int64).view(np.uint64)
    return mixed(mixed(codes * _LETTER) + (places + np.uint64(1)) * _PLACE)


def _codes(same_length: list[str]) -> np.ndarray:
    return np.frombuffer("".join(same_length).encode("utf-32-le"), "<u4").astype(np.uint64).reshape(len(same_length), -1)


def _hash(codes: np.ndarray) -> np.ndarray:
    return np.bitwise_xor.reduce(_marks(codes, 0), axis=1)


def word_hash(word: str) -> int:
    return int(_hash(_codes([word]))[0])


def _deletions(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, place, hash)`` of the distinct words one code point shorter."""
    shifted = _marks(codes, -1)  # each letter one place further left
    after = np.zeros_like(codes)
    after[:, :-1] = np.bitwise_xor.accumulate(shifted[:, :0:-1], axis=1)[:, ::-1]
    before = np.zeros_like(codes)
    before[:, 1:] = np.bitwise_xor.accumulate(_marks(codes, 0)[:, :-1], axis=1)
    last = np.ones(codes.shape, bool)  # of equal letters in a row, deleting any gives the same word
    last[:, :-1] = codes[:, 1:] != codes[:, :-1]
    row, place = np.nonzero(last)
    return row, place, (before ^ after)[row, place]


def _replacements(codes: np.ndarray, own: np.ndarray, first: int, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(row, place, letter, hash)`` of the words with the letter at a place from ``first`` on replaced by a later one."""
    without = own[:, None] ^ _marks(codes, first)
    put = _marks(np.broadcast_to(letters[:, None], (len(letters), codes.shape[1])), first).T  # place, letter
    row, place, letter = np.nonzero(letters > codes[:, :, None])
    return row, place + first, letters[letter], (without[:, :, None] ^ put)[row, place, letter]


# -- filters -------------------------------------------------------------------


def _blocks(mixed_h: np.ndarray, total: int | np.ndarray) -> np.ndarray:
    return (((mixed_h >> np.uint64(32)) * np.uint64(total)) >> np.uint64(32)).view(np.int64)


def _lane_bits(mixed_h: np.ndarray, lane: int) -> np.ndarray:
    return np.uint32(1) << ((mixed_h.astype(np.uint32) * _SALTS[lane]) >> np.uint32(27))


def total_blocks(n_words: int) -> int:
    return max(1, -(-n_words // BLOCK_WORDS))


class Filter:
    """Segments of the blocked Bloom filters that one broadcast holds."""

    def __init__(self, totals: dict[int, int], segments: dict[tuple[int, int], bytes]):
        self.totals = totals
        self.arrays: dict[int, tuple[int, np.ndarray]] = {}
        for length, group in groupby(sorted(segments), key=lambda k: k[0]):
            numbers = [s for _, s in group]
            whole = np.concatenate([np.frombuffer(segments[length, s], "<u4").reshape(-1, LANES) for s in numbers])
            self.arrays[length] = numbers[0] * SEGMENT, whole  # segments of one length are neighbours

    def __contains__(self, length: int) -> bool:
        return length in self.arrays

    def may_hold(self, length: int, h: np.ndarray) -> np.ndarray:
        """Places in ``h`` of the hashes that words of this length in these segments may have."""
        first, bits = self.arrays[length]
        h = mixed(h)
        block = _blocks(h, self.totals[length]) - first
        at = np.flatnonzero((block >= 0) & (block < len(bits)))
        h, block = h[at], block[at]
        for lane in range(LANES):  # most hashes end after a lane or two
            held = np.flatnonzero(bits[block, lane] & _lane_bits(h, lane))
            at, h, block = at[held], h[held], block[held]
        return at


def _coded(batches: Iterable) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            held = sorted(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), key=lambda r: len(r[0]))
            for length, group in groupby(held, key=lambda r: len(r[0])):
                same = list(group)
                for (word, n), h in zip(same, _hash(_codes([w for w, _ in same])).view(np.int64).tolist(), strict=True):
                    yield word, n, length, h

    yield from batches_of(rows(), CODED)


def _segmented(batches: Iterable, totals: dict[int, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length, h = (np.asarray(batch.column(c)) for c in ("length", "h"))
        block = _blocks(mixed(h.view(np.uint64)), np.array([totals[x] for x in length.tolist()], np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(length), pa.array(block // SEGMENT), pa.array(h)], schema=SEGMENTED)


def _filter(table: pa.Table, totals: dict[int, int]) -> pa.Table:
    length, segment = table.column("length")[0].as_py(), table.column("segment")[0].as_py()
    h = mixed(table.column("h").to_numpy().view(np.uint64))
    bits = np.zeros((min(SEGMENT, totals[length] - segment * SEGMENT), LANES), np.uint32)
    block = _blocks(h, totals[length]) - segment * SEGMENT
    for lane in range(LANES):
        np.bitwise_or.at(bits[:, lane], block, _lane_bits(h, lane))
    return pa.table([[length], [segment], [bits.astype("<u4").tobytes()]], schema=FILTERS)


def _bundles(totals: dict[int, int], bundle_bytes: int) -> Iterator[dict[int, tuple[int, int]]]:
    """Ranges of segments per length that fit into one broadcast together."""
    held: dict[int, tuple[int, int]] = {}
    size = 0
    for length in sorted(totals):
        for segment in range(-(-totals[length] // SEGMENT)):
            own = min(SEGMENT, totals[length] - segment * SEGMENT) * LANES * 4
            if held and size + own > bundle_bytes:
                yield held
                held, size = {}, 0
            held[length] = held.get(length, (segment,))[0], segment + 1
            size += own
    if held:
        yield held


def _probe(batches: Iterable, known: Broadcast, letters: str) -> Iterator[pa.RecordBatch]:
    """Neighbours of each word that the filter may hold; a word of the vocabulary has only its ``letters``."""
    filters: Filter = known.value
    alphabet = np.array([ord(x) for x in letters], np.uint64)

    def positives() -> Iterator[tuple]:
        for batch in batches:
            held = sorted(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), key=lambda r: len(r[0]))
            for length, group in groupby(held, key=lambda r: len(r[0])):
                same = list(group)
                step = max(1, PIECE // (length * len(alphabet)))
                for at in range(0, len(same), step):
                    yield from _of(same[at : at + step], length)

    def _of(same: list[tuple], length: int) -> Iterator[tuple]:
        codes = _codes([w for w, _ in same])
        if length > 1 and length - 1 in filters:
            row, place, h = _deletions(codes)
            for i in filters.may_hold(length - 1, h).tolist():
                word, n = same[row[i]]
                yield word, n, word[: place[i]] + word[place[i] + 1 :]
        if length in filters:
            own = _hash(codes)
            span = max(1, PIECE // (len(same) * len(alphabet)))
            for first in range(0, length, span):
                row, place, letter, h = _replacements(codes[:, first : first + span], own, first, alphabet)
                for i in filters.may_hold(length, h).tolist():
                    word, n = same[row[i]]
                    yield word, n, word[: place[i]] + chr(int(letter[i])) + word[place[i] + 1 :]

    yield from batches_of(positives(), POSITIVES)


def neighbours(vocab: DataFrame, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """``(word, n, other, other_n)``: all pairs of words one code point apart, each pair once."""
    spark = vocab.sparkSession
    small_batches(spark)
    coded = settle(vocab.select("word", "n").mapInArrow(_coded, ddl(CODED)), "coded")
    # one row per length; a vocabulary with so many lengths that this is large would be far larger itself
    totals = {r["length"]: total_blocks(r["n"]) for r in coded.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # at most as many rows as there are letters
    letters = "".join(sorted(r[0] for r in coded.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect()))
    segmented = coded.select("length", "h").mapInArrow(partial(_segmented, totals=totals), ddl(SEGMENTED))

    def one(table: pa.Table) -> pa.Table:
        return _filter(table, totals)

    grouped = segmented.groupBy("length", "segment").applyInArrow(one, ddl(FILTERS))
    filters = settle(grouped, "filters")
    found = None
    for ranges in _bundles(totals, bundle_bytes):
        inside = [(F.col("length") == k) & (F.col("segment") >= lo) & (F.col("segment") < hi) for k, (lo, hi) in ranges.items()]
        of_bundle = _any(inside)
        segments = {(r["length"], r["segment"]): bytes(r["bits"]) for r in filters.where(of_bundle).collect()}
        known = spark.sparkContext.broadcast(Filter(totals, segments))
        lengths = sorted({k for at in ranges for k in (at, at + 1)})
        probed = coded.where(F.col("length").isin(lengths)).select("word", "n").mapInArrow(partial(_probe, known=known, letters=letters), ddl(POSITIVES))
        positives = settle(probed, "positives")
        known.destroy()
        found = positives if found is None else found.unionAll(positives)
    if found is None:
        found = spark.createDataFrame([], ddl(POSITIVES))
    return found.join(vocab.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other").select("word", "n", "other", "other_n")


def _any(conditions: list[Column]) -> Column:
    """One of ``conditions`` holds; put together in a balanced tree, so many of them nest little."""
    while len(conditions) > 1:
        conditions = [a | b for a, b in zip(conditions[::2], conditions[1::2], strict=False)] + conditions[len(conditions) & ~1 :]
    return conditions[0]


def variants(vocab: DataFrame, ratio: int = 2, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each word of ``(word, n)``.

    The form of a word is its most frequent near word (ties: the smallest by code points) if that is ``ratio`` times as frequent;
    the root is what the forms lead to.  A form is more frequent than its word, so forms never lead back, and a chain has at most
    as many steps as ``ratio`` goes into the highest count; each round of joins doubles the steps.
    """
    vocab = settle(vocab, "vocabulary")
    near = neighbours(vocab, bundle_bytes)
    ends = F.array(F.struct("word", "n", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    directed = near.select(F.explode(ends).alias("e")).select("e.*")
    best = directed.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("best"))
    often = -F.col("best.m") >= ratio * F.col("n")
    joined = vocab.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, F.col("best.other")).alias("form"),
        F.when(often, -F.col("best.m")).alias("form_n"),
    )
    rows = settle(joined, "forms")
    roots = settle(rows.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if roots.join(further, "root", "left_semi").isEmpty():
            break
        roots = settle(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
