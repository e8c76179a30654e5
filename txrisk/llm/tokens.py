"""Token ids of whole texts by the tokenizers library, with a memo of repeated words.

A tokenizer whose words never cross a space gives the same ids for a text as for its
space-separated parts one after the other, so each task encodes a part once and looks
it up from then on.  A part not seen before is, if it is plain, put together from its
lower-case words, digits and marks, which are seen far more often.  This holds for vocabularies
that lower-case and split at letters, digits and marks, as ``word_bpe_49k.json`` does; the tests
compare it with the library's ids of whole texts.
"""

from __future__ import annotations

import os
import re
from functools import reduce
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: entries of a memo; a full memo starts anew, which changes speed only
MEMO = 300_000
#: longer parts are not kept
LONGEST = 64

#: the letter that stands for each byte in byte-level vocabularies: printable Latin-1 as it is, the
#: others from U+0100 on in order
BYTE_LETTERS = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
BYTE_LETTERS |= {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in BYTE_LETTERS)}


def byte_letters(word: str) -> str:
    """``word`` (without spaces) in the letters of byte-level vocabularies."""
    return word if word.isascii() and word.isprintable() else "".join(map(BYTE_LETTERS.__getitem__, word.encode()))


#: Latin letters whose lower case does not depend on what stands around them, and ASCII without the
#: apostrophe (it begins contractions) and the bracket that special tokens begin with
_LETTERS = "A-Za-zÀ-ÖØ-öø-įĲ-ž"
_PLAIN = re.compile(f"[{_LETTERS}!-&(-;=-@[-`{{-~]+")
#: the words such a part falls into: runs of letters, single digits, runs of marks
_WORDS = re.compile(f"[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")
_SPACES = re.compile("[\t\r\f\v]")


def _packed(ids: list[int]) -> bytes:
    return pack(f"<{len(ids)}I", *ids)


class Words(dict):
    """Maps a plain lower-case word to its ids, by the library's model alone."""

    def __init__(self, model, memo: int):
        self.model, self.memo = model, memo

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.memo:
            self.clear()
        ids = _packed([t.id for t in self.model.tokenize(byte_letters(word))])
        if len(word) < LONGEST:
            self[word] = ids
        return ids


class Encoder(dict):
    """Maps a space-free part of a text to its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, memo: int = MEMO):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words = Words(self.tokenizer.model, memo)
        self.memo = memo

    def __missing__(self, part: str) -> bytes:
        if len(self) >= self.memo:
            self.clear()
        if _PLAIN.fullmatch(part):
            ids = b"".join(map(self.words.__getitem__, _WORDS.findall(part.lower())))
        else:
            ids = _packed(self.tokenizer.encode(part, add_special_tokens=False).ids)
        if len(part) < LONGEST:
            self[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of ``text``, four bytes each."""
        return b"".join(map(self.__getitem__, _SPACES.sub(" ", text.replace("\n", " ")).split(" ")))


    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``texts`` one after the other, and how many each has.

        Arrow finds the distinct parts, so each is looked up once however often it occurs.
        """
        spaced = pa.array([reduce(lambda t, c: t.replace(c, " "), "\n\t\r\f\v", t) for t in texts], pa.large_string())
        split = pc.split_pattern(spaced, " ")
        coded = split.values.dictionary_encode()
        distinct = pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary)
        # parts hold no space, so one string of all of them is taken apart faster than an array
        joined = pc.binary_join(distinct, pa.scalar(" ", pa.large_string()))[0].as_py()
        own = list(map(self.__getitem__, joined.split(" "))) if len(coded) else []
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
        first = np.cumsum(sizes) - sizes
        part = coded.indices.to_numpy()
        n = sizes[part]
        ends = np.concatenate(([0], np.cumsum(n)))
        place = np.repeat(first[part] - ends[:-1], n)
        place += np.arange(len(place))
        return np.frombuffer(b"".join(own), "<u4")[place], np.diff(ends[split.offsets.to_numpy()])


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, memo: int = MEMO) -> Encoder:
    """The encoder of this worker for the tokenizer file ``path``; one with another memo gives way to it."""
    if (path, memo) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, memo] = Encoder(path, memo)
    return _ENCODERS[path, memo]
