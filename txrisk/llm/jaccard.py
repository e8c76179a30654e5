"""Exact Jaccard join of word n-gram sets: size-banded tiles with hashed bitmap signatures.

Sets are banded by size so that two sets can be alike enough only in one band or in neighbouring ones.  A tile holds
the sets of one band, and of the band below, that have one item among the first of their items in one fixed order; sets that
meet in no tile cannot be alike enough (the first items are so many that whatever is left is too little).  Within a tile a
pair goes through the bounds one after the other: sizes, what is left behind the item, bits, items.  The bits of a set tell
for each of so many classes of items whether an odd number of them is in it (about two classes per item, the
same number for all sets of a band); where the bits of two sets differ there is an item that one of them lacks, so a bit count bounds the
overlap from above.  Pairs that pass are decided by intersecting the sorted items.

Equal sets are one class and enter once.  No tile is expanded into all its pairs: in a tile, the sets are first compared with one
of them (``STARS`` times, another one each time) and linked sets become components; only sets in tiles that still hold
several components go on.  For these, items that more than ``COMMON`` components share (passages, lines) move to the end of the
order, and the items behind them take their places; a set's stored window has some to spare, and the few sets
without enough of them list all their items.  Then components meet before their members do, and members only where sizes and what is
left allow a link.  Every pair that may be linked is either compared or already joined, so components are exact; of two
sets with more than one path between them not every link is tested.

Null and empty texts, and texts without words, have an empty set and are linked with nothing; a text with fewer words than
a shingle is one item.  Every row is a document of its own: rows with equal ids are linked only through their
texts.  A null id is never the smallest of a component that has ids; a component without ids has none.  An empty table gives an empty result; a
text of any length is one row's array of 64-bit hashes in a task.  Columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import batches_of, ddl, only, rows_of, small_batches, texts
from txrisk.llm.components import components
from txrisk.llm.shingles import common, set_digest, shingle_set
from txrisk.session import new_path, remove, settle

#: so many times the sets of a tile are compared with one of them
STARS = 3
#: pairs of one set that one task compares
PAIRS_PER_TASK = 256
#: sets of one component that one task pairs with another component's sets
MEETS_PER_TASK = 4096
#: an item of more components than this comes last in the order
COMMON = 16
#: items of a set's window beyond the first ones: so many, or this share of the set
SPARE, SPARE_SHARE = 32, 0.05
#: bits of the short signature that goes with a set into its tiles, as so many words
SHORT_BITS, SHORT = 256, ("f0", "f1", "f2", "f3")
#: bits of the largest signature
MOST_BITS = 1 << 15

SKETCHES = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("window", pa.list_(pa.int64())),
     ("bits", pa.list_(pa.int64())), *[(f, pa.int64()) for f in SHORT]]
)
SETS = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("items", pa.binary())])
ITEMS = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("component", pa.int64()), ("item", pa.int64())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


# -- sizes, bands, signatures ---------------------------------------------------


def band_edges(percent: int) -> np.ndarray:
    """The smallest size of each band: a set is alike enough to none that is two bands away."""
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(edges[-1] * 100 // percent + 1)
    return np.array(edges, np.int64)


def signature_bits(n: int, edges: np.ndarray) -> int:
    """Classes of items for the sets of the band of ``n``, from ``SHORT_BITS`` to ``MOST_BITS``; neighbouring bands differ by a factor of 2 at most."""
    least = int(edges[np.searchsorted(edges, n, "right") - 1])
    return min(MOST_BITS, max(SHORT_BITS, 1 << (2 * least - 1).bit_length()))


def signature(items: np.ndarray, bits: int) -> np.ndarray:
    """Whether the items of each class are odd in number, as 64-bit words."""
    odd = np.bincount((items & np.uint64(bits - 1)).view(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def apart(a: Column, b: Column) -> Column:
    """How many items, at least, are in one of two sets alone; the longer signature is folded to the shorter."""

    def folded(x: Column, length: Column) -> Column:
        pieces = F.transform(F.sequence(F.lit(0), (F.size(x) / length).cast("int") - 1), lambda k: F.slice(x, k * length + 1, length))
        nothing = F.array_repeat(F.lit(0).cast("long"), length)
        return F.when(F.size(x) == length, x).otherwise(F.aggregate(pieces, nothing, lambda s, y: F.zip_with(s, y, lambda p, q: p.bitwiseXOR(q))))

    length = F.least(F.size(a), F.size(b))
    differ = F.zip_with(folded(a, length), folded(b, length), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(differ, F.lit(0), lambda s, x: s + x)


def may_overlap(left: Column, sizes: Column, percent: int) -> Column:
    """An overlap of ``left`` at most is enough for sets of so many items together."""
    return (100 + percent) * left >= percent * sizes


def first_items(n, percent: int):
    """How many of the first items of a set of ``n`` (a number or a column of them) must be looked at."""
    return (n * (100 - percent) - n * (100 - percent) % 100) / 100 + 1 if isinstance(n, Column) else n * (100 - percent) // 100 + 1


# -- sets of texts ----------------------------------------------------------------


def _sketch(batches: Iterable, words: int, percent: int) -> Iterator[pa.RecordBatch]:
    edges = band_edges(percent)

    def rows() -> Iterator[tuple]:
        for doc_id, text in rows_of(batches):
            items = shingle_set(text, words)
            n = len(items)
            if n:
                window = items[: first_items(n, percent) + max(SPARE, int(SPARE_SHARE * n))].view(np.int64)
                yield doc_id, n, *set_digest(items), window, signature(items, signature_bits(n, edges)), *signature(items, SHORT_BITS).tolist()
            else:
                yield doc_id, 0, 0, 0, None, None, *[None] * len(SHORT)

    yield from batches_of(rows(), SKETCHES, flush=256)


def _sets(batches: Iterable, words: int) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for _, text in rows_of(batches):
            items = shingle_set(text, words)
            yield *set_digest(items), items.tobytes()

    yield from batches_of(rows(), SETS, flush=256)


def sets_of(ids: DataFrame, classes: DataFrame, plain: DataFrame, words: int) -> DataFrame:
    """``(id, items)`` of some classes, from the texts of their smallest document id.

    Texts are not shuffled: those that may have one of these ids are made into sets where they are, and the sets are found by their digests.
    """
    wanted = settle(classes.join(ids, "id", "left_semi").select("id", "h1", "h2", "least_id"), "wanted")
    rows = only(plain, "doc_id", wanted, "least_id").mapInArrow(partial(_sets, words=words), ddl(SETS))
    found = rows.dropDuplicates(["h1", "h2"]).join(wanted.select("h1", "h2", "id"), ["h1", "h2"])
    return settle(found.select("id", "items"), "sets")


def band_column(n: Column, percent: int) -> Column:
    """The band of a size."""
    edges = F.array(*[F.lit(int(e)) for e in band_edges(percent)])
    return F.size(F.filter(edges, lambda e: e <= n))


# -- decisions on pairs -------------------------------------------------------------


def _intersect(batches: Iterable, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come by ``(a, slice)`` with the set of ``a`` first, then those it is compared with."""

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


def by_bits(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those ``(a, b)`` whose bits allow a link, by the short signatures first."""
    names = ("n", *SHORT, "bits")
    for end in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("id").alias(end), *[F.col(x).alias(f"{x}_{end}") for x in names]), end)
    sizes = F.col("n_a") + F.col("n_b")
    short = reduce(add, [F.bit_count(F.col(f"{f}_a").bitwiseXOR(F.col(f"{f}_b"))) for f in SHORT])
    near = may_overlap((sizes - short) / 2, sizes, percent)
    near = near & may_overlap((sizes - apart(F.col("bits_a"), F.col("bits_b"))) / 2, sizes, percent)
    return settle(pairs.where(near).select("a", "b"), "pairs")


def decide(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those distinct ``(a, b)`` that are alike enough, by their items.

    A set travels once per ``PAIRS_PER_TASK`` pairs it is the first of, so a set in very many pairs is spread over many tasks.
    """
    slices = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_TASK).alias("slices"))
    sliced = pairs.join(slices, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("slices")).alias("slice"))
    right = sliced.join(sets.withColumnRenamed("id", "b"), "b").select("a", "slice", "b", "items")
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice")
    left = slices.join(sets.withColumnRenamed("id", "a"), "a").select("a", numbers, F.lit(None).cast("long").alias("b"), "items")
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = left.unionByName(right).repartition(n, "a", "slice").sortWithinPartitions("a", "slice", F.col("b").asc_nulls_first())
    return settle(together.select("a", "b", "items").mapInArrow(partial(_intersect, percent=percent), ddl(LINKS)), "links")


# -- tiles ----------------------------------------------------------------------------


def with_components(entries: DataFrame, labels: DataFrame | None) -> DataFrame:
    entries = entries.drop("component")
    if labels is None:
        return entries.withColumn("component", F.col("id"))
    return entries.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))


def open_entries(entries: DataFrame) -> DataFrame:
    """Entries whose tile, or one of their two tiles, still holds several components."""
    tiled = entries.select("item", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("tile"), "component")
    several = tiled.groupBy("item", "tile").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("item", "tile")
    # an open tile holds two bands, so one join finds the entries of all open tiles
    bands = several.select("item", F.explode(F.array(F.col("tile"), F.col("tile") - 1)).alias("band")).distinct()
    return entries.join(bands, ["item", "band"], "left_semi")


def star_pairs(entries: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each set of a tile with the one that comes first, and the first ones of neighbouring bands."""
    order = F.struct(F.xxhash64("id", F.lit(turn)).alias("turn"), "id", "n", "left", "component")
    firsts = entries.groupBy("item", "band").agg(F.min(order).alias("first"))
    met = entries.join(firsts, ["item", "band"]).select("id", "n", "left", "component", "first")
    above = firsts.select("item", (F.col("band") - 1).alias("band"), F.col("first").alias("next"))
    across = firsts.join(above, ["item", "band"]).select("next.id", "next.n", "next.left", "next.component", "first")
    both = met.unionByName(across).where(F.col("component") != F.col("first.component"))
    alike = 100 * F.least("n", "first.n") >= percent * F.greatest("n", "first.n")
    near = may_overlap(F.least("left", "first.left"), F.col("n") + F.col("first.n"), percent)
    return both.where(alike & near).select(F.least("id", "first.id").alias("a"), F.greatest("id", "first.id").alias("b")).distinct()


def _items(batches: Iterable) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            items = np.frombuffer(batch.column("items")[row].as_buffer(), np.int64)
            own = [pa.array(np.full(len(items), batch.column(name)[row].as_py(), np.int64)) for name in ("id", "n", "component")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(items)], ITEMS.names)


def common_last(shared: DataFrame, open_ids: DataFrame, labels: DataFrame, sets, percent: int) -> DataFrame:
    """Entries ``(id, n, component, band, item, left, early)`` of the open sets, with common items at the end of the order.

    ``shared`` has the items of windows that several sets have there, ``sets`` gives all items of some ids.  An item that is common has a row
    for each window it is in, so where a set's window holds enough other items, its first ones are known from there.
    """
    labelled = with_components(shared, labels)
    times = labelled.select("item", "component").distinct().groupBy("item").agg(F.count(F.lit(1)).alias("times"))
    hot = settle(times.where(F.col("times") > COMMON), "common")
    own = labelled.join(open_ids, "id", "left_semi").join(hot, "item", "left")
    before = Window.partitionBy("id").orderBy("place")
    is_hot = F.col("times").isNotNull().cast("long")
    placed = own.select("*", (F.col("place") - F.sum(is_hot).over(before)).alias("at"), F.sum(is_hot).over(Window.partitionBy("id")).alias("n_hot"))
    # with a common item before it, the row of the window's last item tells how many others there are
    placed = settle(placed.withColumn("short", F.col("n_window") - F.col("n_hot") < F.least(F.col("n"), F.col("first"))), "placed")
    long_ = placed.where(~F.col("short") & F.col("times").isNull() & (F.col("at") < F.col("first")))
    entries = long_.select("id", "n", "component", "band", "item", (F.col("n") - F.col("at")).alias("left"))
    short = placed.where("short").select("id", "n", "component", "band").distinct()
    if not short.isEmpty():
        listed = sets(short.select("id")).join(short.select("id", "n", "component"), "id").select("id", "n", "component", "items")
        items = listed.mapInArrow(_items, ddl(ITEMS)).join(hot, "item", "left")
        # unsigned order of the hashes, as in the windows; common items by how common they are
        turn = F.struct(F.coalesce("times", F.lit(0)).alias("times"), F.col("item").bitwiseXOR(F.lit(-(1 << 63))).alias("turn"), "item")
        ordered = items.groupBy("id", "n", "component").agg(F.slice(F.sort_array(F.collect_list(turn)), F.lit(1), first_items(F.col("n"), percent).cast("int")).alias("found"))
        ordered = ordered.select("*", band_column(F.col("n"), percent).alias("band"))
        listed = ordered.select("id", "n", "component", "band", F.posexplode("found").alias("at", "one"))
        entries = entries.unionByName(listed.select("id", "n", "component", "band", F.col("one.item").alias("item"), (F.col("n") - F.col("at")).alias("left")))
    early = (100 + percent) * F.col("left") >= 2 * percent * F.col("n")
    return settle(open_entries(settle(entries.select("*", early.alias("early")), "entries")), "entries")


def near_enough(all_: str, any_: str, sizes: Column, percent: int) -> Column:
    """Whether so many bits may differ, of what every member has, or no member has, here and there."""
    here = [F.col(f"{f}{all_}").bitwiseAND(F.bitwise_not(F.col(f"{f}any"))) for f in SHORT]
    there = [F.col(f"{f}all").bitwiseAND(F.bitwise_not(F.col(f"{f}{any_}"))) for f in SHORT]
    differ = reduce(add, [F.bit_count(h.bitwiseOR(t)) for h, t in zip(here, there, strict=True)])
    return (100 - percent) * sizes >= (100 + percent) * differ


def callers(once: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """``(cx, cy, slices, ix, nx)`` and bits: members of ``cx`` that may be alike enough to some member of ``cy``, by its sizes and by the bits that all or none of it have.

    A large component that meets many others would be made anew for each of them without these bounds.
    """
    x = members.select(F.col("component").alias("cx"), F.col("id").alias("ix"), F.col("n").alias("nx"), *SHORT)
    fits = (F.col("nx") <= F.col("most")) & (100 * F.col("nx") >= percent * F.col("least"))
    fits = fits & near_enough("", "", F.col("nx") + F.col("most"), percent)
    return once.join(x, "cx").where(fits).select("cx", "cy", "slices", "ix", "nx", *SHORT)


def meetings(entries: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of sets in different components that share a tile and may be alike enough.

    The smaller set of a pair finds the other by an early item, in its own band or the next.  Components meet first, by
    what they have at best in the tile; then the members that can be alike enough to some member of the other, by sizes, by what
    is left and by their short signatures, so a pair that its bits rule out is not even formed.  Components too are held against each other by
    the bits that all or none of their members have.  Two components that meet in many tiles are paired once and not in each of them,
    wherever all their pairs are no more than those in their tiles together.  The members of a large component are cut into slices, so a tile that many sets share is spread over many tasks.
    """
    # read several times below, so the signatures are joined once
    entries = settle(entries.join(classes.select("id", *SHORT), "id"), "signed")
    y = entries.select("item", F.col("band").alias("tile"), F.col("component").alias("cy"), F.col("id").alias("iy"), F.col("n").alias("ny"), F.col("left").alias("ly"), *[F.col(f).alias(f"{f}y") for f in SHORT])
    tiles = F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("tile")
    x = entries.where("early").select("item", tiles, F.col("component").alias("cx"), F.col("id").alias("ix"), F.col("n").alias("nx"), F.col("left").alias("lx"), *SHORT)
    # bits that all members of a component have, and those that none has: where one has and the other has not, every two members differ
    tops = y.groupBy("item", "tile", "cy").agg(
        F.min("ny").alias("least"), F.max("ny").alias("most"), F.max("ly").alias("top"), F.count(F.lit(1)).alias("ky"), F.ceil(F.count(F.lit(1)) / MEETS_PER_TASK).alias("slices"),
        *[F.bit_and(f"{f}y").alias(f"{f}all") for f in SHORT], *[F.bit_or(f"{f}y").alias(f"{f}any") for f in SHORT],
    )
    own = x.groupBy("item", "tile", "cx").agg(
        F.min("nx").alias("own_least"), F.max("nx").alias("own_most"), F.max("lx").alias("own_top"), F.count(F.lit(1)).alias("kx"),
        *[F.bit_and(f).alias(f"{f}own_all") for f in SHORT], *[F.bit_or(f).alias(f"{f}own_any") for f in SHORT],
    )

    met = own.join(tops, ["item", "tile"]).where((F.col("cx") != F.col("cy")) & (F.col("own_least") <= F.col("most")))
    met = met.where(may_overlap(F.least("own_top", "top"), F.col("own_least") + F.greatest("own_least", "least"), percent))
    met = met.where(near_enough("own_all", "own_any", F.col("own_most") + F.col("most"), percent))
    met = settle(met.drop("own_least", "own_most", "own_top", *[f"{f}own_{x}" for f in SHORT for x in ("all", "any")]), "met")
    smaller = (F.col("nx") < F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("ix") < F.col("iy")))
    sizes = F.col("nx") + F.col("ny")
    differ = reduce(add, [F.bit_count(F.col(f).bitwiseXOR(F.col(f"{f}y"))) for f in SHORT])
    alike = smaller & (100 * F.col("nx") >= percent * F.col("ny")) & ((100 + percent) * (sizes - differ) >= 2 * percent * sizes)
    each_slice = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice")
    pair = [F.least("ix", "iy").alias("a"), F.greatest("ix", "iy").alias("b")]

    # components that meet on many items meet once, member by member, if that is less than what their members would on each of these items
    members = entries.select("component", "id", "n", *SHORT).distinct()
    counts = members.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    whole = members.groupBy(F.col("component").alias("cy")).agg(
        F.min("n").alias("least"), F.max("n").alias("most"), *[F.bit_and(f).alias(f"{f}all") for f in SHORT], *[F.bit_or(f).alias(f"{f}any") for f in SHORT]
    )
    times = met.groupBy("cx", "cy").agg(F.sum(F.col("kx") * F.col("ky")).alias("times"))
    for end in ("cx", "cy"):
        times = times.join(counts.select(F.col("component").alias(end), F.col("members").alias(f"of_{end}")), end)
    once = times.where(F.col("of_cx") * F.col("of_cy") <= F.col("times"))
    once = settle(once.select("cx", "cy", F.ceil(F.col("of_cy") / MEETS_PER_TASK).alias("slices")).join(whole, "cy"), "once")
    left = callers(once, members, percent).select("cy", "ix", "nx", *SHORT, each_slice)
    right = members.select(F.col("component").alias("cy"), F.col("id").alias("iy"), F.col("n").alias("ny"), *[F.col(f).alias(f"{f}y") for f in SHORT])
    right = right.join(once.select("cy", "slices").distinct(), "cy").withColumn("slice", F.pmod(F.xxhash64("iy"), F.col("slices")))
    at_once = left.join(right, ["cy", "slice"]).where(alike).select(*pair)

    met = met.drop("kx", "ky").join(once.select("cx", "cy"), ["cx", "cy"], "left_anti")
    wanted = (F.col("nx") <= F.col("most")) & may_overlap(F.least("lx", "top"), F.col("nx") + F.greatest("nx", "least"), percent)
    wanted = wanted & near_enough("", "", F.col("nx") + F.col("most"), percent)
    near = met.join(x, ["item", "tile", "cx"]).where(wanted)
    near = near.select("item", "tile", "cy", "ix", "nx", "lx", *SHORT, each_slice)
    sliced = y.join(met.select("item", "tile", "cy", "slices").distinct(), ["item", "tile", "cy"])
    sliced = sliced.select("item", "tile", "cy", "iy", "ny", "ly", *[f"{f}y" for f in SHORT], F.pmod(F.xxhash64("iy"), F.col("slices")).alias("slice"))
    on_items = near.join(sliced, ["item", "tile", "cy", "slice"]).where(alike & may_overlap(F.least("lx", "ly"), sizes, percent)).select(*pair)
    return at_once.unionByName(on_items).distinct()


# -- the join ---------------------------------------------------------------------------


def classes_and_components(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(doc_id, n, h1, h2)`` of all rows, classes of equal sets with their ids, and the component of each class that is linked."""
    spark = docs.sparkSession
    small_batches(spark)
    plain = texts(docs)
    wide = new_path(spark, "sketches")
    plain.mapInArrow(partial(_sketch, words=words, percent=percent), ddl(SKETCHES)).write.parquet(wide)
    sketches = spark.read.schema(ddl(SKETCHES)).parquet(wide)
    rows = settle(sketches.select("doc_id", "n", "h1", "h2"), "rows")
    grouped = sketches.where("n > 0").groupBy("h1", "h2").agg(
        F.min("doc_id").alias("least_id"), F.first("n").alias("n"), F.first("window").alias("window"), F.first("bits").alias("bits"),
        *[F.first(f).alias(f) for f in SHORT],
    )
    # a written table keeps the numbers its rows were given
    classes = settle(grouped.select("*", F.monotonically_increasing_id().alias("id"), band_column(F.col("n"), percent).alias("band")), "classes")
    remove(spark, wide)
    exploded = classes.select("id", "n", "band", F.size("window").alias("n_window"), F.posexplode("window").alias("place", "item"))
    held = settle(exploded.groupBy("item").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("item"), "held")
    # most items are in one window only, and their rows stay behind
    exploded = only(exploded, "item", held, "item")
    shared = settle(exploded.join(held, "item", "left_semi").withColumn("first", first_items(F.col("n"), percent).cast("long")), "shared")
    entries = shared.where("place < first").select("id", "n", "band", "item", (F.col("n") - F.col("place")).alias("left"))
    # tiles of one component give no pairs; before there are links, few of these items are in such tiles
    entries = with_components(entries, None)

    links = tried = labels = known = None

    def sets(ids: DataFrame) -> DataFrame:
        """All items of some classes; each class is read from its text once."""
        nonlocal known
        new = ids if known is None else ids.join(known.select("id"), "id", "left_anti")
        new = sets_of(new, classes, plain, words)
        known = new if known is None else known.unionByName(new)
        return known

    def test(pairs: DataFrame) -> bool:
        """Compare pairs that were not compared yet; whether there were any."""
        nonlocal links, tried, labels
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = settle(pairs, "pairs")
        near = by_bits(pairs, classes, percent)
        tried = pairs if tried is None else tried.unionByName(pairs)
        if near.isEmpty():
            return False
        ends = near.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        found = decide(near, sets(ends), percent)
        links = found if links is None else links.unionByName(found)
        if not found.isEmpty():
            labels = components(links)
        return True

    for turn in range(STARS):
        if turn:
            # most tiles that close do so by the first links, and the last ones are left out below
            labelled = with_components(entries, labels)
            entries = settle(open_entries(labelled) if turn == 1 else labelled, "entries")
        if not test(star_pairs(entries, turn, percent)):
            break
    rest = open_entries(with_components(entries, labels)).select("id").distinct()
    test(meetings(common_last(shared, settle(rest, "open"), labels, sets, percent), classes, percent))
    if labels is None:
        labels = classes.select("id", F.col("id").alias("component")).limit(0)
    return rows, classes.select("id", "h1", "h2", "least_id"), labels


def join(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row of ``docs``: the smallest id its text reaches by links."""
    rows, classes, labels = classes_and_components(docs, words, percent)
    placed = classes.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = placed.join(least, "component").select("h1", "h2", "component_id")
    joined = rows.join(named, ["h1", "h2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
