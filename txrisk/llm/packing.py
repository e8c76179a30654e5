"""Packing token ids into sequences by vector bin packing with the dot-product rule.

A piece asks for tokens, one segment and the tokens it is trained on; a sequence offers a
limit of each.  The open sequence takes, of the pieces that fit, the one whose demands have
the largest weighted dot product with what it still offers.  When none fits, one is cut to
fill it.  Documents longer than a sequence are cut to full sequences first.  What is left
at the end of a task is cut to powers of two, which need no padding.

Each task packs its own rows as they come and holds at most ``BLOCK_DOCS`` documents or
``BLOCK_IDS`` ids, and the texts that are encoded together (``SLICE_CHARS`` characters and one text), so there is no shuffle and no large group.  A null text is empty and gives
its end id alone; equal rows are packed like any others; an empty table gives no pieces.
Columns besides ``doc_id``, ``text`` and (if named) ``prompt_chars`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import batches_of, ddl, rows_of, small_batches
from txrisk.llm.tokens import encoder

#: documents, and ids, that are packed together
BLOCK_DOCS = 768
BLOCK_IDS = 1 << 19
#: texts of so many characters are encoded together
SLICE_CHARS = 4_000_000

PIECES = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
     ("loss_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]
)


class Limits(NamedTuple):
    """What a sequence holds at most."""

    tokens: int = 2048
    segments: int = 128
    loss_tokens: int = 2048


class Piece(NamedTuple):
    """Part of a document: ids from ``start`` on; those before ``prompt`` bear no loss."""

    doc_id: int | None
    ids: bytes
    prompt: int
    start: int
    length: int

    @property
    def loss(self) -> int:
        return self.start + self.length - min(max(self.prompt, self.start), self.start + self.length)

    def head(self, tokens: int, loss: int) -> int:
        """How many of its first tokens fit within so many tokens and loss-bearing tokens."""
        free = max(0, min(self.prompt - self.start, self.length))
        return min(tokens, self.length, free + loss)

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return self._replace(length=n), self._replace(start=self.start + n, length=self.length - n)


class Packer:
    """Packs pieces block by block; ``pack`` gives full sequences and keeps what is left."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.left: list[Piece] = []

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Take a document; its full sequences leave at once."""
        while True:
            n = piece.head(self.limits.tokens, self.limits.loss_tokens)
            if n == piece.length and n < self.limits.tokens:
                self.left.append(piece)
                return
            if n < self.limits.tokens:  # the limit of loss-bearing tokens binds: leave the rest to others
                head, piece = piece.cut(n)
                self.left.append(head)
                continue
            head, piece = piece.cut(n)
            yield [head]
            if not piece.length:
                return

    def pack(self, last: bool = False) -> Iterator[list[Piece]]:
        """Fill sequences from what is held; without ``last``, an unfilled one stays."""
        left, self.left = self.left, []
        if not left:
            return
        limit = self.limits
        tokens = np.array([p.length for p in left], float)
        loss = np.array([p.loss for p in left], float)
        open_ = np.ones(len(left), bool)
        # demands count as shares of the limits, weighted by how much of them is asked for in all
        weight = np.array([tokens.sum() / limit.tokens, len(left) / limit.segments, loss.sum() / limit.loss_tokens])
        weight /= weight.sum()
        while open_.any():
            room = Limits(*limit)
            held: list[Piece] = []
            while room.tokens and room.segments:
                fits = open_ & (tokens <= room.tokens) & (loss <= room.loss_tokens)
                worth = (
                    tokens * (weight[0] * room.tokens / limit.tokens**2)
                    + weight[1] * room.segments / limit.segments**2
                    + loss * (weight[2] * room.loss_tokens / limit.loss_tokens**2)
                )
                if fits.any():
                    at = int(np.argmax(np.where(fits, worth, -1.0)))
                    open_[at] = False
                    piece = left[at]
                elif open_.any():  # cut one to fill the rest
                    at = int(np.argmax(np.where(open_, tokens, -1.0)))
                    n = left[at].head(room.tokens, room.loss_tokens)
                    if not n:
                        break
                    piece, left[at] = left[at].cut(n)
                    tokens[at], loss[at] = left[at].length, left[at].loss
                else:
                    break
                held.append(piece)
                room = Limits(room.tokens - piece.length, room.segments - 1, room.loss_tokens - piece.loss)
            if room.tokens == 0 or open_.any():
                yield held
            elif last:
                yield from powers(held)
            else:
                self.left = held


def powers(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """``pieces`` in sequences whose lengths are powers of two, the longest first."""
    total = sum(p.length for p in pieces)
    pieces = pieces[::-1]
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        held = []
        while room:
            piece = pieces.pop()
            if piece.length > room:
                piece, rest = piece.cut(room)
                pieces.append(rest)
            held.append(piece)
            room -= piece.length
        yield held


def _slices(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
    """Rows whose texts are encoded together."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[1] or "")
        if chars >= SLICE_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


def _pack(batches: Iterable, path: str, end_id: int, limits: Limits) -> Iterator[pa.RecordBatch]:
    encode = encoder(path)
    end = int(end_id).to_bytes(4, "little")
    packer = Packer(limits)

    def encoded() -> Iterator[tuple]:
        for rows in _slices(rows_of(batches)):
            ids, sizes = encode.encode_all([text or "" for _, text, _ in rows])
            first = 0
            for (doc_id, text, prompt_chars), n in zip(rows, sizes.tolist(), strict=True):
                prompt = len(encode.encode((text or "")[:prompt_chars])) // 4 if prompt_chars else 0
                yield doc_id, ids[first : first + n].tobytes() + end, prompt
                first += n

    def sequences() -> Iterator[list[Piece]]:
        held = 0
        for doc_id, ids, prompt in encoded():
            yield from packer.add(Piece(doc_id, ids, prompt, 0, len(ids) // 4))
            held += len(ids) // 4
            if len(packer.left) >= BLOCK_DOCS or held >= BLOCK_IDS:
                yield from packer.pack()
                held = sum(p.length for p in packer.left)
        yield from packer.pack(last=True)

    def pieces() -> Iterator[tuple]:
        first = TaskContext.get().partitionId() << 33
        for number, sequence in enumerate(sequences()):
            offset = 0
            for p in sequence:
                ids = p.ids[4 * p.start : 4 * (p.start + p.length)]
                yield p.doc_id, p.start, p.length, len(p.ids) // 4, p.loss, first + number, offset, ids
                offset += p.length

    yield from batches_of(pieces(), PIECES, flush=1024)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, limits: Limits | None = None, prompt_chars: str | None = None) -> DataFrame:
    """The pieces of ``docs``: each id of each document is in exactly one.

    ``prompt_chars`` may name a column with how many code points at the beginning of a text
    bear no loss (instruction data).  ``sequence_id`` grows with the task and is unique.
    """
    small_batches(docs.sparkSession)
    prompt = F.col(prompt_chars).cast("int") if prompt_chars else F.lit(0)
    columns = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(prompt, F.lit(0)).alias("prompt_chars"))
    return columns.mapInArrow(partial(_pack, path=tokenizer, end_id=end_id, limits=limits or Limits()), ddl(PIECES))
