"""The numbered operators as queries over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm import bpe, exact, jaccard, licenses, neardup, packing, parsing, pii, repair, spelling, toxicity, warc, whitening
from txrisk.llm.common import documents
from txrisk.session import new_path, settle

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    _REGISTRY[f.__name__] = f
    return f


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_repair_ids(spark, sf_dir):
    path = new_path(spark, "repair")
    repair.write(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), path, end_id=2)
    return repair.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op3_pack(spark, sf_dir):
    pieces = packing.pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "loss_tokens"
    )


@query
def op8_bpe_stream(spark, sf_dir):
    return bpe.encode_decode(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


@query
def op5_minhash_tensor(spark, sf_dir):
    return neardup.near_duplicates(documents(spark, sf_dir), neardup.Params(words=2, percent=80))


@query
def op2_consistent_parsing(spark, sf_dir):
    return parsing.fingerprints(documents(spark, sf_dir))


@query
def op4_toxicity_mil(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).select(
        "doc_id", "held_out", "score", "predicted", "n_sentences", "worst_start", "worst_end", "worst_score", "offending"
    )


@query
def op6_license_diagonals(spark, sf_dir):
    return licenses.scan(documents(spark, sf_dir)).drop("notices")


@query
def op7_exact_copies(spark, sf_dir):
    return exact.copies(documents(spark, sf_dir))


@query
def op9_personal_data(spark, sf_dir):
    return pii.find(documents(spark, sf_dir))


@query
def op10_warc_transactions(spark, sf_dir):
    path = new_path(spark, "warc")
    warc.write(spark.read.parquet(f"{sf_dir}/pages.parquet"), path, least_bytes=0)
    captures = warc.assemble(warc.read(spark, path, with_payload=False)).select(
        "capture_id",
        warc.field(F.col("metadata")[0], "pageId").cast("long").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("refers_to"),
        F.col("response.uri").alias("uri"),
    )
    captures = settle(captures, "captures")
    # what a revisit refers to is a record; its page is that of the capture
    referred = captures.where("record_type = 'response'").select(F.col("capture_id").alias("_id"), F.col("page_id").alias("_page"))
    joined = captures.join(referred, captures["refers_to"] == referred["_id"], "left")
    return joined.select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("_page").alias("refers_to"), "uri")


@query
def op11_jaccard_tiles(spark, sf_dir):
    return jaccard.join(documents(spark, sf_dir), words=5, percent=80)


@query
def op12_whitening(spark, sf_dir):
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", components=8, scale=1024, shift=100_000)


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling.variants(spelling.vocabulary(spelling.words(documents(spark, sf_dir), drop_every=97), least_length=5, least_times=3), ratio=2)
