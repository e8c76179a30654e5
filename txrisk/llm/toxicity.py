"""Toxicity by multiple-instance learning: labels are of documents, scores are of sentences.

A sentence's score is a logistic function of its words; a document is toxic if any sentence is, so
its score is the noisy-or of them, ``1 - product(1 - score)``.  The weights are fitted to
the likelihood of the document labels, and then tell which sentences offend: all whose own score reaches the threshold.

The model is fitted on at most ``per_class`` labelled documents of each class (those whose hashed ids are
smallest), each standing for as many as there are in all; everything else reads the whole table.  Only words of the text
are inputs.  Null and empty texts have no sentence and the score 0.  A label that is null is not used;
of several labels of a document the largest counts.  Rows are scored one by one, so
ties, repeated rows, other columns (whatever their names) and empty tables change nothing; without labels of
both classes every score is 0.  A text of any length is read sentence by sentence, and only sentences that offend are held.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import batches_of, ddl, rows_of, small_batches, texts

#: slots of the hashed weights
SLOTS = 1 << 18
PER_CLASS = 2000
THRESHOLD = 0.3
#: words that fewer sampled documents hold have no weight
LEAST_DOCS = 3

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")

INSTANCES = pa.schema([("doc_id", pa.int64()), ("words", pa.binary()), ("sizes", pa.binary())])
SCORED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("n_sentences", pa.int64()),
     ("worst_start", pa.int64()), ("worst_end", pa.int64()), ("worst_score", pa.float64()),
     ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))]
)


class Model(NamedTuple):
    """Weights by slot (those that are not 0) and the constant."""

    weights: dict[int, float]
    constant: float


def held_out(column):
    """Documents that take no part in fitting."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


#: besides itself, a word is told by its beginnings of these lengths, which compounds and endings share
BEGINNINGS = (4, 5, 6)


def slot(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature.encode("utf-8", "surrogatepass")) % SLOTS


@lru_cache(50_000)
def slots(word: str) -> tuple[int, ...]:
    """The slots of a word and of its beginnings."""
    return slot(word), *(slot(f"{word[:n]}-") for n in BEGINNINGS if len(word) >= n)


def sentences(text: str) -> Iterator[tuple[int, int, set[str]]]:
    """Where each sentence with words begins and ends, and its words in lower case."""
    for found in _SENTENCE.finditer(text):
        words = set(_WORD.findall(found[0].lower()))
        if words:
            yield found.start(), found.end(), words


def _instances(batches: Iterable) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for doc_id, text in rows_of(batches):
            found = [sorted({x for w in words for x in slots(w)}) for _, _, words in sentences(text)]
            yield doc_id, np.array([w for s in found for w in s], "<u4").tobytes(), np.array([len(s) for s in found], "<u4").tobytes()

    yield from batches_of(rows(), INSTANCES, flush=256)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Fit on documents with a label that are not held out."""
    spark = docs.sparkSession
    small_batches(spark)
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id").cast("long")))
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("label"))
    counts = {r.label: r["count"] for r in usable.groupBy("label").count().collect()}
    if len(counts) < 2:
        return Model({}, -math.inf)
    chosen = {}
    for label in (0, 1):  # at most per_class ids of each class, whatever the table holds
        first = usable.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen |= {r.doc_id: label for r in first.select("doc_id").collect()}
    ids = spark.createDataFrame([(i,) for i in chosen], "doc_id long")
    sample = texts(docs).join(F.broadcast(ids), "doc_id").mapInArrow(_instances, ddl(INSTANCES))
    rows = sorted(sample.collect(), key=lambda r: (r.doc_id, bytes(r.words)))
    y = np.array([chosen[r.doc_id] for r in rows], float)
    if not 0 < y.sum() < len(y):
        return Model({}, -math.inf)
    share = np.where(y > 0, counts[1] / y.sum(), counts[0] / (len(y) - y.sum()))
    return descend([(np.frombuffer(r.words, "<u4"), np.frombuffer(r.sizes, "<u4")) for r in rows], y, share / share.sum())


def telling(bags: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """The slots that go with a label beyond chance: G-test of each, at a level for as many as there are."""
    n, pos = len(y), y.sum()
    total, with_ = np.zeros(SLOTS), np.zeros(SLOTS)
    for bag, label in zip(bags, y, strict=True):
        own = np.unique(bag)
        total[own] += 1
        with_[own] += label

    def part(seen: np.ndarray, rows: np.ndarray, share: float) -> np.ndarray:
        return np.where(seen > 0, 2 * seen * np.log(np.maximum(seen, 1) / np.maximum(rows * share, 1e-12)), 0.0)

    g = sum(
        part(seen, rows, share)
        for rows, own in ((total, with_), (n - total, pos - with_))
        for seen, share in ((own, pos / n), (rows - own, 1 - pos / n))
    )
    return np.flatnonzero((total >= LEAST_DOCS) & (g >= 2 * math.log(max(2, int((total > 0).sum()))) + 4))


def slopes(w: np.ndarray, words: np.ndarray, sentence: np.ndarray, doc_of_sentence: np.ndarray, y: np.ndarray, share: np.ndarray, decay: float) -> np.ndarray:
    """The gradient of the weighted log-likelihood, less the decay; ``words[i]`` stands in sentence ``sentence[i]``, the last of ``w`` is the constant."""
    z = w[-1] + np.bincount(sentence, w[words], len(doc_of_sentence))
    p = 1 / (1 + np.exp(-z))
    none = np.bincount(doc_of_sentence, -np.logaddexp(0, z), len(y))  # log of no toxic sentence
    some = -np.expm1(none)
    pull = share * np.where(y > 0, np.exp(none) / np.maximum(some, 1e-12), -1.0)
    g = pull[doc_of_sentence] * p
    grad = np.append(np.bincount(words, g[sentence], len(w) - 1), g.sum())
    grad[:-1] -= decay * w[:-1]
    return grad


def descend(bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, share: np.ndarray, steps: int = 200, decay: float = 1e-6) -> Model:
    """Maximise the weighted likelihood of the labels under noisy-or, by Adam."""
    often = telling([w for w, _ in bags], y)
    index = np.full(SLOTS, -1, np.int32)
    index[often] = np.arange(len(often))
    # only words with a weight are kept, so the sample is in memory once, as it came
    words, sentence, n_sentences, n = [], [], [], 0
    for bag, sizes in bags:
        own = index[bag]
        words.append(own[own >= 0])
        sentence.append((np.repeat(np.arange(len(sizes), dtype=np.int32), sizes) + n)[own >= 0])
        n_sentences.append(len(sizes))
        n += len(sizes)
    words, sentence = np.concatenate(words), np.concatenate(sentence)
    doc_of_sentence = np.repeat(np.arange(len(bags)), n_sentences)
    w = np.zeros(len(often) + 1)
    w[-1] = -4.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        grad = slopes(w, words, sentence, doc_of_sentence, y, share, decay)
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        w += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model({int(s): float(x) for s, x in zip(often, w[:-1], strict=True) if abs(x) > 1e-3}, float(w[-1]))


class _Weights(dict):
    def __init__(self, model: Model):
        self.by_slot = model.weights

    def __missing__(self, word: str) -> float:
        if len(self) >= 200_000:
            self.clear()
        weight = math.fsum(self.by_slot.get(x, 0.0) for x in slots(word))
        if len(word) < 64:
            self[word] = weight
        return weight


def _score(batches: Iterable, model: Model, threshold: float) -> Iterator[pa.RecordBatch]:
    weight = _Weights(model).__getitem__

    def rows() -> Iterator[tuple]:
        for doc_id, text in rows_of(batches):
            none, n, worst = 0.0, 0, (-math.inf, None, None)
            offend: list[tuple[int, int, float]] = []
            for start, end, words in sentences(text):
                z = model.constant + math.fsum(map(weight, words))
                n += 1
                none -= max(z, 0.0) + math.log1p(math.exp(-abs(z)))
                if z > worst[0]:
                    worst = (z, start, end)
                own = _logistic(z)
                if own >= threshold:
                    offend.append((start, end, own))
            told = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 4 == 2
            yield doc_id, told, -math.expm1(none), n, worst[1], worst[2], _logistic(worst[0]), *([x[k] for x in offend] for k in range(3))

    yield from batches_of(rows(), SCORED)


def _logistic(z: float) -> float:
    return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted``, the number of sentences, the one that offends most, and all that offend.

    ``offending`` has ``(start, end, score)``, in code points, of each sentence whose own score reaches ``threshold``.  A document can be toxic without
    one, by many sentences that are each a little so.
    """
    small_batches(docs.sparkSession)
    scored = texts(docs).mapInArrow(partial(_score, model=model, threshold=threshold), ddl(SCORED))
    offend = F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end"), F.col("scores").alias("score"))
    offend = offend.cast("array<struct<start:bigint,end:bigint,score:double>>")
    scored = scored.withColumn("offending", offend).drop("starts", "ends", "scores")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _keep(batches: Iterable, model: Model, threshold: float, at: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches whose text scores less."""
    weight = _Weights(model).__getitem__
    for batch in batches:
        keep = []
        for text in batch.column(at).to_pylist():
            none = 0.0
            for _, _, words in sentences(text or ""):
                z = model.constant + math.fsum(map(weight, words))
                none -= max(z, 0.0) + math.log1p(math.exp(-abs(z)))
            keep.append(-math.expm1(none) < threshold)
        yield batch.filter(pa.array(keep, pa.bool_()))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score less than ``threshold``, with all columns."""
    small_batches(docs.sparkSession)
    step = partial(_keep, model=model, threshold=threshold, at=docs.columns.index("text"))
    # Spark takes a dot in a name for a field, so columns go by number through the Python step
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(step, plain.schema).toDF(*docs.columns)
