"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read again as
the next one's ``docs``.  All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from txrisk.llm import exact, neardup, packing, pii, toxicity
from txrisk.llm.queries import tokenizer_path
from txrisk.session import settle


def drop_toxic(spark, docs, sf_dir):
    """Documents that the classifier rejects go; it learns from the labelled ones among those given."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_copies(spark, docs, sf_dir):
    """One of equal texts stays."""
    return exact.drop_copies(docs)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each near-duplicate group stays: five words, a likeness of 0.8."""
    return neardup.drop_near_duplicates(docs, neardup.Params(words=5, percent=80))


def mask_personal_data(spark, docs, sf_dir):
    """Personal data gives way to masks."""
    return pii.mask(docs)


def pack(spark, docs, sf_dir):
    """Sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

#: a fitted classifier, MinHash and a tokenizer are beyond SQL; the tests compare with brute force
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages one after the other on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
