"""The Jaccard join, whitening and spelling variants against plain versions."""

import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402

pytest.importorskip("txrisk.llm")

from txrisk.llm import common, jaccard, neardup, spelling, whitening  # noqa: E402
from txrisk.session import settle  # noqa: E402

SCHEMA = "doc_id long, text string, `a.b` string, key string, item long, component long"


def made():
    """Chains of texts just above and below the limit, a passage that all share, copies, odd texts."""
    rnd = random.Random(5)
    word = lambda: f"w{rnd.randint(0, 10**6)}"
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(6):
        base = [word() for _ in range(rnd.choice([7, 30, 120, 400]))]
        for k in range(12):
            own = list(base)
            for _ in range(k % 7 if len(base) > 20 else k % 2):
                own[rnd.randrange(len(own))] = word()
            texts.append(" ".join(own))
    for k in range(40):  # the passage is most of some texts and little of others
        own = [word() for _ in range(rnd.choice([2, 10, 15, 80, 300]))]
        texts.append(" ".join(own[: k % 5] + passage + own[k % 5 :]))
    odd = [None, "", " ", "one", "ONE", "one two", "a b c d e", "a b c d e f", " ".join(passage * 400)]
    return texts + odd + texts[:10]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", "k", 1, 2) for i, t in enumerate(made())]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.mark.parametrize(("words", "percent"), [(5, 80), (2, 60)])
def test_jaccard_join(docs, monkeypatch, words, percent):
    monkeypatch.setattr(jaccard, "COMMON", 3)
    monkeypatch.setattr(jaccard, "SPARE", 4)
    monkeypatch.setattr(jaccard, "MEETS_PER_TASK", 3)
    least, sizes = brute.components(dict(enumerate(made())), words, percent)
    found = jaccard.join(docs, words, percent).collect()
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in found} == {i: (least[i], sizes[i]) for i in least}
    assert len(found) == len(least) and len(set(least.values())) < len(least)


def test_jaccard_join_of_odd_rows(spark):
    a = " ".join(f"a{i}" for i in range(60))
    z = " ".join(f"z{i}" for i in range(60))
    rows = [(4, a), (4, z), (5, a + " more"), (6, z + " more"), (None, a), (None, "alone here"), (7, None), (7, None)]
    found = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id or 0, r.n_shingles) for r in found) == [
        (False, 4, 4, 56), (False, 4, 4, 56), (False, 5, 4, 57), (False, 6, 4, 57), (False, 7, 7, 0), (False, 7, 7, 0), (True, 0, 0, 1), (True, 0, 4, 56)
    ]
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bands_and_bits():
    for percent in (50, 60, 80, 95):
        edges = jaccard.band_edges(percent)
        band = lambda n, e=edges: int(np.searchsorted(e, n, "right"))
        for n in range(1, 400):
            assert band(n * 100 // percent) <= band(n) + 1
            assert jaccard.signature_bits(n, edges) in (256, 512, 1024)
    rnd = np.random.default_rng(1)
    for _ in range(200):
        a, b = (np.unique(rnd.integers(0, 300, rnd.integers(1, 200)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(2))
        differ = np.bitwise_count((jaccard.signature(a, 256) ^ jaccard.signature(b, 256)).view(np.uint64)).sum()
        assert differ <= len(np.setxor1d(a, b))


def whitened(spark, rows, **options):
    return whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>, component int, n long, id long"), **options)


def test_whitening(spark):
    rnd = np.random.default_rng(2)
    data = (rnd.standard_normal((400, 12)) * np.linspace(3, 0.2, 12)).astype(np.float32)
    rows = [(i, v.tolist(), 0, 0, 0) for i, v in enumerate(data)]
    bad = [(900, None, 0, 0, 0), (901, [1.0] * 11, 0, 0, 0), (902, [float("nan")] * 12, 0, 0, 0), (903, [None] * 12, 0, 0, 0), (904, [], 0, 0, 0), (905, [float("inf")] * 12, 0, 0, 0)]
    rows += [(None, data[3].tolist(), 0, 0, 0), (5, data[5].tolist(), 0, 0, 0)]
    x = np.floor(np.concatenate([data, data[[3, 5]]]).astype(float) * 1024).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    y = (n * x - s) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    out = whitened(spark, rows + bad).toPandas()
    assert len(out) == 8 * n and set(out.n) == {n} and out.identity_error.max() < 1e-10
    found = out[out.vec_id == 17].sort_values("component")
    want = (y @ vectors / np.sqrt(values))[17]
    assert np.allclose(np.abs(found.whitened), np.abs(want), atol=1e-10)
    assert np.allclose(found.explained, values / np.trace(y.T @ y / n), rtol=1e-12)
    assert set(found.deviation) == {int(((n * x[17] - s) ** 2).sum())}
    assert out.vec_id.isna().sum() == 8 and (out.vec_id == 5).sum() == 16


def test_whitening_without_variance(spark):
    same = [(i, [0.5, 0.25], 0, 0, 0) for i in range(4)]
    assert whitened(spark, same).count() == whitened(spark, []).count() == 0
    line = [(i, [0.5 * i, 0.25 * i, 1.0], 0, 0, 0) for i in range(9)]
    assert {r.component for r in whitened(spark, line).collect()} == {1}


def test_eigenpairs_of_clustered_values():
    rnd = np.random.default_rng(3)
    q, _ = np.linalg.qr(rnd.standard_normal((90, 90)))
    values = np.concatenate([[5, 5, 5 - 1e-9, 4, 4, 2], np.geomspace(1, 1e-9, 84)])
    v = (q * values) @ q.T
    found, vectors = whitening.jacobi_davidson(lambda b: v @ b, 90, 8)
    assert np.allclose(found, np.sort(values)[::-1][:8], rtol=1e-13)
    assert np.abs(v @ vectors - vectors * found).max() < 1e-12


def plain_variants(counts):
    near = {w: set() for w in counts}
    for w in counts:
        for x in counts:
            a, b = sorted((w, x), key=len)
            if len(a) == len(b):
                close = sum(p != q for p, q in zip(a, b, strict=True)) == 1
            else:
                close = len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))
            if close:
                near[w].add(x)
    form = {w: min(near[w], key=lambda x: (-counts[x], x), default=None) for w in counts}
    form = {w: f if f and counts[f] >= 2 * counts[w] else None for w, f in form.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts}


@pytest.mark.parametrize("bundle_bytes", [spelling.BUNDLE_BYTES, 40])
def test_spelling_variants(spark, bundle_bytes, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 500)
    monkeypatch.setattr(spelling, "SEGMENT", 1)
    rnd = random.Random(7)
    counts = {"".join(rnd.choice("abéß÷") for _ in range(rnd.randint(2, 6))): rnd.randint(1, 60) for _ in range(400)}
    counts |= {"a" * 3000: 9, "a" * 2999: 30, "a" * 2998 + "b": 4}
    vocab = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(vocab, bundle_bytes=bundle_bytes).collect()}
    assert found == plain_variants(counts)


def test_words_of_texts(spark):
    rows = [(1, "Straße ÀB x1yZ\u0100q ÷a"), (2, None), (None, ""), (None, "null id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.word for r in spelling.words(docs).collect()) == sorted(["straße", "Àb", "x", "yz", "q", "÷a", "null", "id"])
    import zlib

    want = []
    for i, t in rows:
        for w in {1: ["straße", "Àb", "x", "yz", "q", "÷a"]}.get(i, ["null", "id"] if t else []):
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            want.append(w[: h % len(w)] + w[h % len(w) + 1 :] if h % 2 == 0 else w)
    assert sorted(r.word for r in spelling.words(docs, 2).collect()) == sorted(want)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.vocabulary(spelling.words(empty))).count() == 0
    assert spelling.vocabulary(spelling.words(docs), 2, 1).where(F.col("n") != 1).count() == 0


def test_pairs_that_bits_rule_out_are_not_formed(spark):
    """100 sets of 100 items with one early item in common: only those with nearly the same bits meet."""
    full = (1 << 63) - 1
    rows = [(i, 100, i, 7, 0, True, *[(full if k == i % 4 else 0) ^ (i % 3 == 0) for k in range(4)]) for i in range(100)]
    entries = spark.createDataFrame(rows, "id long, n long, component long, item long, place long, early boolean, f0 long, f1 long, f2 long, f3 long")
    found = {(r.lo, r.hi) for r in neardup.meetings(entries, 80).collect()}
    assert found == {(a, b) for a in range(100) for b in range(a + 1, 100) if a % 4 == b % 4}


def test_only_rows_that_may_be_wanted_are_left(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"t{i}") for i in [*range(5000), None]], "id long, filter_word string")
    wanted = spark.createDataFrame([(i,) for i in [*range(0, 5000, 250), None, None, 9999]], "who long")
    left = [r.id for r in common.only(rows, "id", wanted, "who").collect()]
    assert {*range(0, 5000, 250), None} <= set(left) and len(left) == len(set(left)) < 100
    assert common.only(rows, "id", wanted.limit(0), "who").isEmpty()
    monkeypatch.setattr(common, "FILTER_WORDS", 1)
    assert {*range(0, 5000, 250), None} <= {r.id for r in common.only(rows, "id", wanted, "who").collect()}


def joins_of(df):
    """The joins of the optimized plan, outermost first."""
    return [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in line]


def test_wanted_rows_are_picked_before_a_semi_join(spark):
    """The bits must be looked at first, whatever join by the value follows, or all rows are shuffled for that join."""
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(500)], "id long, text string")
    wanted = spark.createDataFrame([(i,) for i in range(0, 500, 50)], "id long")
    left = common.only(rows, "id", wanted, "id").join(wanted, "id", "left_semi")
    assert sorted(r.id for r in left.collect()) == list(range(0, 500, 50))
    assert ["getbit" in line for line in joins_of(left)] == [False, True]


def test_sets_are_found_without_a_shuffle_of_texts(spark):
    docs = spark.createDataFrame([(i, f"a b c d{i % 30}") for i in range(60)] + [(None, "x y")], "doc_id long, text string")
    p = neardup.Params(words=2)
    sketches = [(neardup.set_digest(neardup.shingle_set(t, 2)), i) for i, t in [(3, "a b c d3"), (7, "a b c d7"), (None, "x y")]]
    named = spark.createDataFrame([(n, *h, i) for n, (h, i) in enumerate(sketches)], "id long, h1 long, h2 long, least_id long")
    sets = neardup.sets_of(docs, named, p)
    assert sorted((r.id, r.size) for r in sets.collect()) == [(0, 3), (1, 3), (2, 1)]
    shuffles = [line for line in sets._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert not any("doc_id" in line or "least_id" in line for line in shuffles)


def test_components_that_share_many_items_are_paired_once(spark, monkeypatch):
    """Two components of three members that share 40 early items, and one that meets them on one item."""
    ids = [(i, i // 3, item) for i in range(6) for item in range(40)] + [(i, 2, 0) for i in range(6, 26)]
    entries = spark.createDataFrame([(i, 100, c, 5, item, 100, True) for i, c, item in ids], "id long, n long, component long, band int, item long, left long, early boolean")
    classes = spark.createDataFrame([(i, 0, 0, 0, 0) for i in range(26)], "id long, f0 long, f1 long, f2 long, f3 long")
    tables = {}

    def kept(df, name):
        tables[name] = settle(df, name)
        return tables[name]

    monkeypatch.setattr(jaccard, "settle", kept)
    found = sorted((r.a, r.b) for r in jaccard.meetings(entries, classes, 80).collect())
    assert found == [(a, b) for a in range(26) for b in range(a + 1, 26) if min(a // 3, 2) != min(b // 3, 2)]
    assert {(r.cx, r.cy) for r in tables["once"].collect()} >= {(0, 1), (1, 0)}


@pytest.mark.parametrize("first", [True, False])
def test_pairs_are_the_same_once_or_on_each_item(spark, first):
    """A component too large to be paired at once with one it meets on a single item."""
    rows = [(i, 100, 0, 5, 1000 + i if i else 0, 100, True) for i in range(30)] + [(40, 100, 1, 5, 0, 100, True)] + [(41, 100, 1, 5, 3 if first else 1001, 100, True)]
    entries = spark.createDataFrame(rows, "id long, n long, component long, band int, item long, left long, early boolean")
    classes = spark.createDataFrame([(i, 0, 0, 0, 0) for i in range(50)], "id long, f0 long, f1 long, f2 long, f3 long")
    found = sorted((r.a, r.b) for r in jaccard.meetings(entries, classes, 80).collect())
    assert found == [(0, 40)] + ([] if first else [(1, 41)])


def test_a_large_component_is_not_made_for_each_it_meets(spark, monkeypatch):
    """One component of 40 sets shares 60 items with each of 20 others, but each of these can be alike to one of its sets only."""
    bits = [(1 << i) - 1 if i < 63 else -1 for i in range(64)]
    sign = lambda i: [bits[(7 * i + k * i) % 64] ^ (0x5555 * i * (k + 1)) for k in range(4)]
    ids = [(i, 0 if i < 40 else i) for i in range(60)]
    rows = [(i, 30, c, 5, item, 30, True) for i, c in ids for item in range(60)]
    entries = spark.createDataFrame(rows, "id long, n long, component long, band int, item long, left long, early boolean")
    signs = {i: sign(i if i < 40 else i - 40) for i, _ in ids}
    classes = spark.createDataFrame([(i, *f) for i, f in signs.items()], "id long, f0 long, f1 long, f2 long, f3 long")
    differ = lambda a, b: sum(bin((x ^ y) & (1 << 64) - 1).count("1") for x, y in zip(signs[a], signs[b], strict=True))
    near = [(a, b) for a, c in ids for b, d in ids if a < b and c != d and 20 * 60 >= 180 * differ(a, b)]
    met, old = [], jaccard.callers

    def counted(*args):
        met.append(settle(old(*args), "callers"))
        return met[-1]

    monkeypatch.setattr(jaccard, "callers", counted)
    found = sorted((r.a, r.b) for r in jaccard.meetings(entries, classes, 80).collect())
    assert found == sorted(near) and {(i, i + 40) for i in range(20)} <= set(near)
    assert met[0].where("cx = 0").count() == sum(a < 40 for a, _ in near) < 100  # 800 without the bounds
