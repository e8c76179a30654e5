"""Near-duplicates by MinHash with tensored banding, every link confirmed on whole sets.

Two small collections of bands are computed, and each pair of a band of the one and a
band of the other is a table key: ``bands**2`` tables from ``2 * bands`` bands, so the number of
MinHash values is the square root of what as many separate tables would take.  A text whose
likeness to another is s shares a key with it with the chance
``(1 - (1 - s**rows)**bands)**2``: 0.9994 at 0.8 and above 0.9999 at 0.86 with the values here.

Texts with equal sets are one class and enter the tables once.  In a bucket, members are
first compared with one of them (the same order in all buckets), and those not joined to it with another, ``STARS`` times
in all.  Where a bucket still holds
several components, its members go on to a join that leaves out only pairs that cannot be alike enough
(see :func:`candidates`), and every pair it finds in different components is compared.  So no pair that shares a bucket is
left out unless both ends are already joined, and a group of thousands of copies, alike enough or
not quite, costs a few comparisons a copy, not the square.

Null and empty texts, and texts without words, have an empty set and are linked with nothing.
Rows with equal sets are one class, whatever their ids; rows that share an id are linked only through their texts.
A component is named by the smallest id in it.  A row without an id takes the component of its
text (null if no text there has an id) and is kept, as nothing could name it.  A text of any length is one row's array of
64-bit hashes in a task.  The filter keeps one row of
each id that is kept.  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial, reduce
from operator import add
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import batches_of, ddl, only, rows_of, small_batches, texts
from txrisk.llm.components import components
from txrisk.llm.shingles import MinHash, common, mixed, set_digest, shingle_set
from txrisk.session import settle

#: so many comparisons with one text are made by one task
PAIRS_PER_TASK = 256
#: so many times the open buckets are compared with one of their members, another one each time
STARS = 3
#: a set is summed up in ``2**BITS`` bits: whether an odd number of its items begin with each
BITS = 10
#: the same folded to so many words, that go with a set to where it meets others
SHORT = ("f0", "f1", "f2", "f3")


class Params(NamedTuple):
    words: int = 5
    percent: int = 80
    bands: int = 8
    rows: int = 2


SKETCHES = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("keys", pa.list_(pa.int64()))]
)
SETS = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("size", pa.int64()), ("bits", pa.list_(pa.int64())), ("items", pa.binary())])
ITEMS = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("component", pa.int64()), ("item", pa.int64())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def table_keys(values: np.ndarray, minhash: MinHash, p: Params) -> np.ndarray:
    """The ``bands**2`` keys of a set."""
    parts = minhash(values).reshape(2, p.bands, p.rows)
    band = np.full((2, p.bands), 7, np.uint64)
    for r in range(p.rows):
        band = mixed(band * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    table = np.arange(p.bands**2, dtype=np.uint64).reshape(p.bands, p.bands)
    return mixed(mixed(band[0][:, None] + table) * np.uint64(0xC2B2AE3D27D4EB4F) + band[1][None, :]).ravel().view(np.int64)


def _sketch(batches: Iterable, p: Params) -> Iterator[pa.RecordBatch]:
    minhash = MinHash(2 * p.bands * p.rows)

    def rows() -> Iterator[tuple]:
        for doc_id, text in rows_of(batches):
            values = shingle_set(text, p.words)
            if len(values):
                yield doc_id, len(values), *set_digest(values), table_keys(values, minhash, p)
            else:
                yield doc_id, 0, 0, 0, []

    yield from batches_of(rows(), SKETCHES, flush=512)


def _sets(batches: Iterable, p: Params) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for _, text in rows_of(batches):
            values = shingle_set(text, p.words)
            odd = np.bincount((values >> np.uint64(64 - BITS)).view(np.int64), minlength=1 << BITS) & 1
            yield *set_digest(values), len(values), np.packbits(odd.astype(bool)).view(np.int64), values.tobytes()

    yield from batches_of(rows(), SETS, flush=256)


def _confirm(batches: Iterable, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come by ``(a, slice)`` with the set of ``a`` first, then those compared with it."""

    def links() -> Iterator[tuple]:
        left = np.empty(0, np.uint64)
        for a, b, items in rows_of(batches):
            right = np.frombuffer(items, np.uint64)
            if b is None:
                left = right
                continue
            both = common(left, right)
            if 100 * both >= percent * (len(left) + len(right) - both):
                yield a, b

    yield from batches_of(links(), LINKS)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those ``(a, b)`` of distinct ``pairs`` whose sets are alike enough.

    Where the bits of two sets differ, an item is in one of them alone, so pairs that differ in too many
    go by their bits.  For the others, the set of ``b`` travels with the pair, and the set of ``a`` once per
    ``PAIRS_PER_TASK`` pairs of it.
    """
    bits = sets.select("id", "size", "bits")
    for end in ("a", "b"):
        pairs = pairs.join(bits.select(F.col("id").alias(end), F.col("size").alias(f"size_{end}"), F.col("bits").alias(f"bits_{end}")), end)
    apart = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    near = (100 + percent) * apart <= (100 - percent) * (F.col("size_a") + F.col("size_b"))
    pairs = settle(pairs.where(near).select("a", "b"), "pairs")
    sets = sets.select("id", "items")
    slices = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_TASK).alias("slices"))
    sliced = pairs.join(slices, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("slices")).alias("slice"))
    # few sets are left in later rounds, so the others are not shuffled
    right = sliced.join(only(sets, "id", pairs, "b").withColumnRenamed("id", "b"), "b").select("a", "slice", "b", "items")
    left = (
        slices.join(only(sets, "id", pairs, "a").withColumnRenamed("id", "a"), "a")
        .select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"), F.lit(None).cast("long").alias("b"), "items")
    )
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = left.unionByName(right).repartition(n, "a", "slice").sortWithinPartitions("a", "slice", F.col("b").asc_nulls_first())
    return together.select("a", "b", "items").mapInArrow(partial(_confirm, percent=percent), ddl(LINKS))


def _items(batches: Iterable) -> Iterator[pa.RecordBatch]:
    """A row for each item of each set."""
    for batch in batches:
        for row in range(batch.num_rows):
            items = np.frombuffer(batch.column("items")[row].as_py(), np.int64)
            own = [pa.array(np.full(len(items), batch.column(name)[row].as_py(), np.int64)) for name in ("id", "n", "component")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(items)], ITEMS.names)


def candidates(open_: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(lo, hi)`` of sets in different components that may be alike enough.  None is left out.

    Items have one order: first those that one component alone holds, which no pair can share, then the
    rarer before the commoner, counted over all open sets.  The first item that two sets share leaves, in both, only those
    behind it to be shared, so it must stand early in both, and in the smaller set earlier still.  Pairs are
    formed on such items alone; members of one component never meet.
    """
    items = settle(open_.select("id", "n", "component", "items").mapInArrow(_items, ddl(ITEMS)), "items")
    held = items.groupBy("item").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("times"))
    shared = items.join(held.where("lo <> hi").select("item", "times"), "item")
    # the items of a set that are not here come first, so the others count from the end of the set
    ordered = shared.groupBy("id", "n", "component").agg(F.sort_array(F.collect_list(F.struct("times", "item"))).alias("items"))
    entries = ordered.select("id", "n", "component", F.size("items").alias("left"), F.posexplode("items").alias("at", "found"))
    place = F.col("n") - F.col("left") + F.col("at")
    entries = entries.select("id", "n", "component", F.col("found.item").alias("item"), place.alias("place"))
    entries = entries.where(100 * (F.col("n") - F.col("place")) >= percent * F.col("n"))
    early = (100 + percent) * (F.col("n") - F.col("place")) >= 2 * percent * F.col("n")
    entries = settle(entries.withColumn("early", early), "prefixes")
    apart = entries.groupBy("item").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("early").alias("any"))
    entries = settle(entries.join(apart.where("lo <> hi and any").select("item"), "item", "left_semi"), "prefixes")
    return meetings(entries.join(open_.select("id", *SHORT), "id"), percent)


def meetings(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(lo, hi)`` of sets in different components that meet on an item and may be alike enough.

    Components meet before their members do.  What the other component has at best (its least and largest
    size, and the most that is left behind the item) already leaves out the members that can be
    alike enough to none of it, so a large component gives rows to a small one only where they are of use.  Components, members and pairs
    are held against each other by their bits too (of a component, those that all or none of its members have), so pairs that differ in too many are not formed.
    """
    y = entries.select("item", F.col("component").alias("cy"), F.col("id").alias("iy"), F.col("n").alias("ny"), (F.col("n") - F.col("place")).alias("ly"), *[F.col(f).alias(f"{f}y") for f in SHORT])
    x = entries.where("early").select("item", F.col("component").alias("cx"), F.col("id").alias("ix"), F.col("n").alias("nx"), (F.col("n") - F.col("place")).alias("lx"), *SHORT)

    def may(left, size):
        return (100 + percent) * left >= percent * size

    def few(differ: list[Column], size: Column) -> Column:
        """Whether so few bits differ that the sets may be alike enough."""
        return (100 + percent) * reduce(add, [F.bit_count(d) for d in differ]) <= (100 - percent) * size

    def sure(all_: str, any_: str) -> list[Column]:
        """Bits that every member has, or none has, here and not there."""
        here = [F.col(f"{f}{all_}").bitwiseAND(F.bitwise_not(F.col(f"{f}any"))) for f in SHORT]
        there = [F.col(f"{f}all").bitwiseAND(F.bitwise_not(F.col(f"{f}{any_}"))) for f in SHORT]
        return [h.bitwiseOR(t) for h, t in zip(here, there, strict=True)]

    def bits_of(x: str, all_: str, any_: str) -> list[Column]:
        return [F.bit_and(f"{f}{x}").alias(f"{f}{all_}") for f in SHORT] + [F.bit_or(f"{f}{x}").alias(f"{f}{any_}") for f in SHORT]

    tops = y.groupBy("item", "cy").agg(F.min("ny").alias("least"), F.max("ny").alias("most"), F.max("ly").alias("top"), *bits_of("y", "all", "any"))
    own = x.groupBy("item", "cx").agg(F.min("nx").alias("own_least"), F.max("nx").alias("own_most"), F.max("lx").alias("own_top"), *bits_of("", "own_all", "own_any"))
    met = own.join(tops, "item").where((F.col("cx") != F.col("cy")) & (F.col("own_least") <= F.col("most")))
    met = met.where(may(F.least("own_top", "top"), F.col("own_least") + F.greatest("own_least", "least")))
    met = met.where(few(sure("own_all", "own_any"), F.col("own_most") + F.col("most")))
    met = met.drop("own_least", "own_most", "own_top", *[f"{f}own_{k}" for f in SHORT for k in ("all", "any")])
    near = met.join(x, ["item", "cx"]).where((F.col("nx") <= F.col("most")) & may(F.least("lx", "top"), F.col("nx") + F.greatest("nx", "least")) & few(sure("", ""), F.col("nx") + F.col("most")))
    near = near.select("item", "cy", "ix", "nx", "lx", *SHORT)
    smaller = (F.col("nx") < F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("ix") < F.col("iy")))
    alike = (100 * F.col("nx") >= percent * F.col("ny")) & may(F.least("lx", "ly"), F.col("nx") + F.col("ny"))
    alike = alike & few([F.col(f).bitwiseXOR(F.col(f"{f}y")) for f in SHORT], F.col("nx") + F.col("ny"))
    found = near.join(y, ["item", "cy"]).where(smaller & alike)
    return found.select(F.least("ix", "iy").alias("lo"), F.greatest("ix", "iy").alias("hi")).distinct()


def still_open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``(key, id, n, component)`` of the buckets whose members are not all joined yet."""
    labelled = members.select("key", "id", "n").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    keys = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    return labelled.join(keys, "key", "left_semi").select("key", "id", "n", "component")


def sets_of(plain: DataFrame, named: DataFrame, p: Params) -> DataFrame:
    """``(id, size, bits, items)`` of the classes ``named``.

    Texts are not shuffled: those that may have one of the least ids are made into sets where they are, and the sets are found by their digests.
    """
    rows = only(plain, "doc_id", named, "least_id").mapInArrow(partial(_sets, p=p), ddl(SETS))
    return rows.dropDuplicates(["h1", "h2"]).join(named.select("h1", "h2", "id"), ["h1", "h2"]).select("id", "size", "bits", "items")


def classes_and_components(docs: DataFrame, p: Params) -> tuple[DataFrame, DataFrame]:
    """Sketches of all rows, and ``(h1, h2, component_id)`` of each distinct set."""
    small_batches(docs.sparkSession)
    plain = texts(docs)
    sketches = settle(plain.mapInArrow(partial(_sketch, p=p), ddl(SKETCHES)), "sketches")
    grouped = sketches.where("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("least_id"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    # sets, not documents, are linked, as rows may share an id; a written table keeps the numbers its rows were given
    classes = settle(grouped.withColumn("id", F.monotonically_increasing_id()), "classes")
    entries = classes.select(F.explode("keys").alias("key"), "id", "n")
    buckets = entries.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("key")
    # most keys have one member, so those are left behind before anything else is worked out
    members = settle(entries.join(buckets, "key", "left_semi"), "members")
    named = classes.select("id", "h1", "h2", "least_id").join(members.select("id").distinct(), "id", "left_semi")
    named = settle(named, "named")
    sets = settle(sets_of(plain, named, p), "sets")

    def alike(x: str, y: str):
        return 100 * F.least(x, y) >= p.percent * F.greatest(x, y)

    # one order of all ids: the member of a bucket that comes first is compared with the others
    firsts = members.groupBy("key").agg(F.min(F.struct(F.xxhash64("id").alias("turn"), "id", "n")).alias("first"))
    stars = members.join(firsts, "key").where(F.col("id") != F.col("first.id")).where(alike("n", "first.n"))
    stars = settle(stars.select(F.col("first.id").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    links = settle(confirm(stars, sets, p.percent), "links")
    labels = components(links)

    for turn in range(1, STARS):
        members = still_open(members, labels)
        if members.isEmpty():
            break
        members = settle(members, "open")
        firsts = members.groupBy("key").agg(F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("turn"), "id", "n", "component")).alias("first"))
        other = members.join(firsts, "key").where(F.col("component") != F.col("first.component")).where(alike("n", "first.n"))
        more = settle(other.select(F.col("first.id").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
        found = settle(confirm(more, sets, p.percent), "links")
        stars, links = stars.unionByName(more), links.unionByName(found)
        if not found.isEmpty():
            labels = components(links)

    open_ = settle(still_open(members, labels).select("id", "n", "component").distinct(), "open")
    words = len(SHORT)
    short = [reduce(Column.bitwiseXOR, [F.col("bits")[k] for k in range(i, 2**BITS // 64, words)]).alias(f) for i, f in enumerate(SHORT)]
    listed = open_.join(only(sets, "id", open_, "id").select("id", "items", *short), "id")
    rest = candidates(settle(listed, "open"), p.percent)
    tried = stars.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()
    rest = settle(rest.join(tried, ["lo", "hi"], "left_anti").select(F.col("lo").alias("a"), F.col("hi").alias("b")), "pairs")
    if not rest.isEmpty():
        more = settle(confirm(rest, sets, p.percent), "links")
        if not more.isEmpty():
            labels = components(links.unionByName(more))
    found = classes.select("h1", "h2", "id", "least_id").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = found.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return sketches, found.join(least, "component").select("h1", "h2", "component_id")


def near_duplicates(docs: DataFrame, p: Params | None = None) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``docs``."""
    sketches, found = classes_and_components(docs, p or Params())
    narrow = sketches.select("doc_id", F.col("n").alias("n_shingles"), "h1", "h2")
    joined = narrow.join(found, ["h1", "h2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.col("doc_id").isNull()).alias("kept"))


def drop_near_duplicates(docs: DataFrame, p: Params | None = None) -> DataFrame:
    """The rows of ``docs`` of which one per component stays, with all columns."""
    kept = near_duplicates(docs, p).where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").select(*[docs[f"`{c}`"] for c in docs.columns]).dropDuplicates(["doc_id"])
    return named.unionByName(docs.where("doc_id is null"))
