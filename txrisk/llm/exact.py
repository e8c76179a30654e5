"""Exact duplicates: texts that are equal but for the kind and amount of white space.

Rows are grouped by a 128-bit hash of the normalised text, and inside a hash by its bytes, so texts that
only share the hash are groups of their own.  Copies are counted before the shuffle, so a group of
any size is one row per task from there on.

A null text is empty, and all empty texts are copies of each other.  Of equal texts the row with the smallest id
stays; a row without an id stays only if no copy has one.  Rows that are equal in all columns, ids
included, are all marked as the one that stays, and the filter leaves one of them.  An empty table gives an
empty result; other columns are carried by the filter and not read by the marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import free_name
from txrisk.session import settle

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """``text`` with each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def content_hash(text: Column) -> Column:
    """128 bits of the text's bytes."""
    return F.unhex(F.md5(text))


def copies(docs: DataFrame) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for each row of ``docs``."""
    plain = docs.select(F.col("doc_id").cast("long"), normalised(F.col("text")).alias("text"))
    hashed = plain.withColumn("hash", content_hash(F.col("text")))
    groups = hashed.groupBy("hash", "text").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # texts are told apart above by their bytes; from here on a group goes by both of its digests
    groups = settle(groups.select("hash", F.unhex(F.sha2("text", 256)).alias("sha"), "keep_id", "group_size"), "copies")
    rows = hashed.select("doc_id", "hash", F.unhex(F.sha2("text", 256)).alias("sha"))
    return rows.join(groups, ["hash", "sha"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all columns of ``docs``."""
    text, hash_, row = (free_name(docs, n) for n in ("_text", "_hash", "_row"))
    keyed = docs.withColumn(text, normalised(F.col("text"))).withColumn(hash_, content_hash(F.col(text)))
    # of rows with one id and equal texts, which one stays must not depend on their order
    turn = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return keyed.groupBy(hash_, text).agg(F.min_by(whole, turn).alias(row)).select(f"{row}.*")
