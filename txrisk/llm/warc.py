"""WARC archives from pages, and captures assembled from archives.

Writing gives each page a transaction: a request, a response (or a revisit, if a page with an equal
payload and a larger id holds it) and a metadata record, tied by ``WARC-Concurrent-To``.  Reading parses
the records of all files; assembly joins requests and metadata to their response through
those identifiers, in either direction and over any number of records between, and emits one nested row per
capture with all its requests and metadata records.

A null html is an empty payload, a null url is left out, line breaks in a url are escaped.  Rows
without an id are the smallest, so they are responses only if no equal payload has an id.  Repeated rows are captures of
their own, all with the type of their page.  An empty table gives an empty archive; columns besides ``page_id``, ``url`` and
``html`` are not read.  Archives are written by Spark's text writer, so any path Spark reaches will do; a
reader holds a few files at a time, and files are cut to about ``FILE_BYTES``; archives are compressed.  Payloads are equal if both
their SHA-1 and their SHA-256 are.  A record whose length is no number, or whose header has no end, comes out with ``error`` and without a
payload, and reading goes on at the next record; a record that is cut short comes out with ``error`` and what there is of it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.common import batches_of, ddl, rows_of, small_batches
from txrisk.llm.components import components
from txrisk.session import settle

FILE_BYTES = 16 * 1024 * 1024
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ANCHORS = ("response", "revisit", "resource")

TEXT = pa.schema([("value", pa.string())])
RECORDS = pa.schema(
    [("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("uri", pa.string()),
     ("date", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
     ("fields", pa.string()), ("payload", pa.binary()), ("error", pa.string())]
)


def record_id(*of: object) -> str:
    """An identifier that follows from what the record is of."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, of)))}>"


def _record(kind: str, own: str, headers: list[tuple[str, object]], block: str) -> str:
    told = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", DATE), *headers, ("Content-Length", len(block.encode()))]
    lines = "".join(f"{name}: {value}\r\n" for name, value in told if value is not None)
    return f"WARC/1.1\r\n{lines}\r\n{block}"


def _transactions(batches: Iterable) -> Iterator[pa.RecordBatch]:
    def records() -> Iterator[tuple]:
        for page_id, url, html, sha1, keeper in rows_of(batches):
            digest = base64.b32encode(bytes.fromhex(sha1)).decode()
            uri = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
            size = len(html.encode())
            revisit = page_id != keeper
            own = record_id("response", page_id, digest)
            http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
            headers = [("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
            if revisit:
                headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id("response", keeper, digest))]
            yield (_record("revisit" if revisit else "response", own, headers, http if revisit else http + html),)
            asked = [("WARC-Target-URI", uri), ("WARC-Concurrent-To", own), ("Content-Type", "application/http;msgtype=request")]
            yield (_record("request", record_id("request", page_id, digest), asked, f"GET {uri or '/'} HTTP/1.1\r\n\r\n"),)
            about = [("WARC-Target-URI", uri), ("WARC-Concurrent-To", own), ("Content-Type", "application/warc-fields")]
            fields = [("pageId", page_id)]
            body = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
            yield (_record("metadata", record_id("metadata", page_id, digest), about, body),)

    yield from batches_of(records(), TEXT, flush=192)


def write(pages: DataFrame, out: str, least_bytes: int = 0) -> None:
    """Write ``pages`` as archives to ``out``.

    Of pages with equal payloads of at least ``least_bytes`` bytes, the largest ``page_id`` is the response.
    """
    small_batches(pages.sparkSession)
    html = F.coalesce(F.col("html"), F.lit(""))
    plain = pages.select(F.col("page_id").cast("long"), "url", html.alias("html"), F.sha1(html).alias("sha1"))
    equal = F.struct("sha1", F.unhex(F.sha2("html", 256)).alias("sha256"))
    sizes = plain.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("html")).alias("bytes")).first()
    each = (sizes["bytes"] or 0) / max(1, sizes["n"]) + 1500
    large = plain.where(F.octet_length("html") >= least_bytes)
    held = large.groupBy(equal.alias("equal")).agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
    # a written table has a known size: where it is small, pages need not be shuffled to meet it
    held = settle(held.where("n > 1").select("equal", "keeper"), "keepers")
    known = F.when(F.octet_length("html") >= least_bytes, F.coalesce("keeper", "page_id")).otherwise(F.col("page_id"))
    chosen = plain.join(held, equal == held["equal"], "left").select("page_id", "url", "html", "sha1", known.alias("keeper"))
    records = chosen.mapInArrow(_transactions, ddl(TEXT))
    records.write.option("compression", "gzip").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", 3 * max(1, int(FILE_BYTES / each))).text(out)


def _headers(block: bytes) -> tuple[list[tuple[str, str]], int]:
    """Header lines of a record or message, and where what follows them begins."""
    end = block.find(b"\r\n\r\n")
    end = len(block) if end < 0 else end
    lines = (line.partition(":") for line in block[:end].decode("utf-8", "replace").split("\r\n")[1:])
    return [(name.strip().lower(), value.strip()) for name, _, value in lines], min(end + 4, len(block))


_NUMBER = re.compile("[0-9]{1,18}")
_NEXT = re.compile(rb"(?:^|\n)WARC/")


def parse(archive: bytes, with_payload: bool = True) -> Iterator[tuple]:
    """The records of one file as rows of ``RECORDS``."""
    if archive[:2] == b"\x1f\x8b":
        archive = gzip.decompress(archive)
    at = archive.find(b"WARC/")
    while at >= 0:
        end = archive.find(b"\r\n\r\n", at)
        told, _ = _headers(archive[at : end + 4 if end >= 0 else len(archive)])
        one = dict(told)
        length = one.get("content-length", "0")
        if end < 0 or not _NUMBER.fullmatch(length):
            ties = [value for name, value in told if name == "warc-concurrent-to"]
            error = "no end of header" if end < 0 else "length is no number"
            yield one.get("warc-record-id"), one.get("warc-type"), ties, one.get("warc-target-uri"), one.get("warc-date"), one.get("warc-refers-to"), None, None, None, None, error
            following = _NEXT.search(archive, at + 5)
            at = following.end() - 5 if following else -1
            continue
        begin = end + 4
        block = archive[begin : begin + int(length)]
        error = None if len(block) == int(length) else "cut short"
        kind, size, digest, payload, fields = one.get("warc-type"), None, one.get("warc-payload-digest"), None, None
        if one.get("content-type", "").startswith("application/http"):
            http, body = _headers(block)
            payload = block[body:]
            size = len(payload)
            if kind == "revisit":  # the payload is elsewhere, its size is in the message
                stated = dict(http).get("content-length", "")
                size, payload = int(stated) if _NUMBER.fullmatch(stated) else size, None
            elif kind == "response":
                digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
        elif one.get("content-type") == "application/warc-fields":
            fields = block.decode("utf-8", "replace")
        else:
            payload, size = block, len(block)
        ties = [value for name, value in told if name == "warc-concurrent-to"]
        yield (
            one.get("warc-record-id"), kind, ties, one.get("warc-target-uri"), one.get("warc-date"), one.get("warc-refers-to"),
            size, digest and digest.partition(":")[2], fields, payload if with_payload else None, error,
        )
        at = archive.find(b"WARC/", begin + len(block))


def _parsed(batches: Iterable, with_payload: bool) -> Iterator[pa.RecordBatch]:
    yield from batches_of((r for (content,) in rows_of(batches) for r in parse(content, with_payload)), RECORDS, flush=256)


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives in ``path``."""
    small_batches(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    records = files.mapInArrow(partial(_parsed, with_payload=with_payload), ddl(RECORDS))
    return records if with_payload else records.drop("payload")


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, response, requests, metadata``, the last two as arrays in order of their ids.

    Records that are tied to no response are a capture without one, together with what they are tied to.  Of several
    responses a record is tied to, it goes with the one of the smallest id.  ``records`` is stored without payloads first, so
    archives are parsed once for the ties; payloads are read only if the result's are used.
    """
    own = [c for c in records.columns if c not in ("concurrent_to", "payload")]
    narrow = settle(records.select(*own, "concurrent_to"), "records")
    anchor = F.col("type").isin(*ANCHORS)
    ends = narrow.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"))
    ties = ends.unionAll(ends.select(F.col("b").alias("a"), F.col("a").alias("b")))
    anchors = narrow.where(anchor).select(F.col("record_id").alias("b"))
    near = settle(ties.join(anchors, "b", "left_semi").groupBy("a").agg(F.min("b").alias("capture_id")), "near")
    # what is tied to no response itself is reached through others
    reached = near.select("a").unionAll(anchors.select(F.col("b").alias("a")))
    open_ = settle(ties.join(reached, "a", "left_anti"), "open")
    if not open_.isEmpty():
        of = anchors.select("b", F.col("b").alias("capture_id")).unionAll(near.select(F.col("a").alias("b"), "capture_id"))
        # parts hold open records only: one that is not open belongs to its own capture and joins no parts
        apart = open_.join(open_.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        inner = components(apart).withColumnRenamed("id", "a")
        known = open_.select("a").distinct().join(inner, "a", "left").select("a", F.coalesce("component", "a").alias("part"))
        best = open_.join(of, "b").join(known, "a").groupBy("part").agg(F.min("capture_id").alias("capture_id"))
        far = known.join(best, "part", "left").select("a", F.coalesce("capture_id", "part").alias("capture_id"))
        near = near.unionByName(far)
    whole = F.struct(*own)
    tied = narrow.where(~anchor).join(near, narrow["record_id"] == near["a"], "left")
    others = tied.groupBy(F.coalesce("capture_id", "record_id").alias("capture_id")).agg(
        *[F.sort_array(F.collect_list(F.when(kind, whole))).alias(name) for kind, name in ((F.col("type") == "request", "requests"), (F.col("type") == "metadata", "metadata"))]
    )
    # without payloads the stored table has all there is
    with_payload = "payload" in records.columns
    fields = [*own, "payload"] if with_payload else own
    responses = (records if with_payload else narrow).where(anchor).select(F.col("record_id").alias("capture_id"), F.struct(*fields).alias("response"))
    empty = F.array().cast(others.schema["requests"].dataType)
    return responses.join(others, "capture_id", "full").select(
        "capture_id", "response", F.coalesce("requests", empty).alias("requests"), F.coalesce("metadata", empty).alias("metadata")
    )


def field(record: Column, name: str) -> Column:
    """A field of a metadata record's body."""
    return F.str_to_map(record["fields"], F.lit("\r\n"), F.lit(": "))[name]
