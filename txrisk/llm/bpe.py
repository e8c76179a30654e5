"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding as a state machine.

Whether a cut between two tokens stays is decided by the text on its left and by at most
``lookahead`` symbols on its right, a number that follows from the merge list.  The encoder
keeps the symbols since the last cut that is certain and gives out tokens up to the newest
such cut, so memory does not grow with a word or a text.  Words of a usual length end
before the lookahead does and are kept in a bounded memo, as they repeat.

Null texts are empty and have no ids; every row is encoded by itself, so ties, repeated rows,
empty tables and other columns change nothing.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from txrisk.llm.common import batches_of, ddl, rows_of, small_batches, texts
from txrisk.llm.tokens import _PLAIN, _SPACES, _WORDS, BYTE_LETTERS, LONGEST, MEMO, byte_letters

CODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

#: stands for the end of a word while the lookahead is worked out
_END = ""
_BYTES = {letter: byte for byte, letter in BYTE_LETTERS.items()}


class Vocabulary:
    """The merge list and the splitting rules of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model = told["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        pattern = told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")

    def lookahead(self) -> int:
        """How many symbols to the right of a cut can decide whether it stays.

        A merge differs between two continuations of a text only if it reaches into them, or if a
        merge of a lower rank that overlaps it differs.  ``reach`` is how far from its
        beginning such a chain can go; overlapping merges must agree on the text they share.
        """
        reach: dict[str, int] = {}  # by what a merge makes
        begins: dict[str, int] = {}  # the farthest reach of what begins so
        most = 0
        for a, b in self.ranks:
            made = (a + b).replace(self.suffix, _END) if self.suffix else a + b
            n = len(made)
            far = n
            for offset in range(n):
                rest = made[offset:]
                found = begins.get(rest, 0)
                for end in range(offset + 1, n):
                    found = max(found, reach.get(made[offset:end], 0))
                far = max(far, offset + found)
            reach[made] = max(far, reach.get(made, 0))
            for end in range(1, n + 1):
                if far > begins.get(made[:end], 0):
                    begins[made[:end]] = far
            most = max(most, far)
        return most

    def merge(self, symbols: list[str]) -> list[str]:
        """Merge the pair of the lowest rank, the leftmost first, until none is left."""
        if len(symbols) > 48:
            return self._merge_long(symbols)
        rank, none = self.ranks.get, len(self.ranks)
        ranks = [rank(pair, none) for pair in zip(symbols, symbols[1:])]
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            symbols[at] += symbols.pop(at + 1)
            del ranks[at]
            if at:
                ranks[at - 1] = rank((symbols[at - 1], symbols[at]), none)
            if at < len(ranks):
                ranks[at] = rank((symbols[at], symbols[at + 1]), none)
        return symbols

    def _merge_long(self, symbols: list[str]) -> list[str]:
        """The same with a heap of the pairs that may be merged."""
        after = [*range(1, len(symbols)), -1]
        before = [-1, *range(len(symbols) - 1)]
        here: list[str | None] = list(symbols)
        heap = [(r, i) for i, pair in enumerate(zip(symbols, symbols[1:])) if (r := self.ranks.get(pair)) is not None]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            j = after[i]
            if here[i] is None or j < 0 or self.ranks.get((here[i], here[j])) != r:
                continue
            here[i] += here[j]
            here[j] = None
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right >= 0 and (r := self.ranks.get((here[left], here[right]))) is not None:
                    heappush(heap, (r, left))
        return [s for s in here if s is not None]


class Transducer:
    """Turns the symbols of one word into tokens, each as soon as it is certain."""

    def __init__(self, vocabulary: Vocabulary, lookahead: int):
        self.vocabulary = vocabulary
        self.keep = lookahead + 1
        self.held: list[str] = []

    def push(self, symbols: str) -> Iterator[str]:
        """Take a few more symbols; gives the tokens that are certain now."""
        self.held.extend(symbols)
        if len(self.held) >= 3 * self.keep:
            yield from self._certain()

    def _certain(self) -> Iterator[str]:
        """Tokens that end before the lookahead.  No merge crosses a certain cut, so what
        follows it can be merged by itself."""
        at, sure = 0, len(self.held) - self.keep
        for token in self.vocabulary.merge(list(self.held)):
            if at + len(token) > sure:
                break
            at += len(token)
            yield token
        del self.held[:at]

    def finish(self) -> Iterator[str]:
        """The end of the word: the rest of its tokens."""
        if self.held:
            self.held[-1] += self.vocabulary.suffix
            yield from self.vocabulary.merge(self.held)
            self.held = []


class JoinedDecoder:
    """Ids to the tokens themselves with a space between, as tokenizers without a decoder do."""

    def __init__(self, tokens: dict[int, str]):
        self.tokens = tokens
        self.begun = False

    def push(self, token_id: int) -> str:
        token = self.tokens[token_id]
        if self.begun:
            return f" {token}"
        self.begun = True
        return token

    def finish(self) -> str:
        return ""


class TextDecoder:
    """Ids to text: bytes wait until they are a whole character; a word's end gives a space."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.bytes = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, token_id: int) -> str:
        token = self.vocabulary.tokens[token_id]
        if token in self.vocabulary.special:
            return self.bytes.decode(b"", True) + token
        ends = bool(self.vocabulary.suffix) and token.endswith(self.vocabulary.suffix)
        token = token.removesuffix(self.vocabulary.suffix) if ends else token
        text = self.bytes.decode(bytes(map(_BYTES.__getitem__, token)), ends)
        return f"{text} " if ends else text

    def finish(self) -> str:
        return self.bytes.decode(b"", True)


class Coder(dict):
    """Maps a space-free part of a text to its number of ids, the ids as text, and them decoded."""

    def __init__(self, vocabulary: Vocabulary, lookahead: int):
        self.vocabulary = vocabulary
        self.lookahead = lookahead
        self.known: dict[str, tuple[int, str, str]] = {}

    def word_ids(self, word: str) -> Iterator[int]:
        """The ids of one word, streamed."""
        transducer, ids = Transducer(self.vocabulary, self.lookahead), self.vocabulary.ids
        for at in range(0, len(word), 4096):
            yield from map(ids.__getitem__, transducer.push(byte_letters(word[at : at + 4096])))
        yield from map(ids.__getitem__, transducer.finish())

    def ids(self, text: str) -> Iterator[int]:
        """The ids of a text, streamed."""
        v = self.vocabulary
        for piece in v.specials.split(text):
            if piece in v.special:
                yield v.special[piece]
                continue
            piece = "".join(c.lower() for c in unicodedata.normalize("NFC", piece))
            for word in v.words.finditer(piece):
                yield from self.word_ids(word[0])

    def _coded(self, ids: Iterable[int]) -> tuple[int, str, str]:
        decoder = JoinedDecoder(self.vocabulary.tokens)
        ids = list(ids)
        return len(ids), " ".join(map(str, ids)), "".join(map(decoder.push, ids)) + decoder.finish()

    def _word(self, word: str) -> tuple[int, str, str]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= MEMO:
                self.known.clear()
            found = self._coded(self.word_ids(word))
            if len(word) < LONGEST:
                self.known[word] = found
        return found

    def __missing__(self, part: str) -> tuple[int, str, str]:
        if len(self) >= MEMO:
            self.clear()
        if _PLAIN.fullmatch(part):
            words = [self._word(w) for w in _WORDS.findall(part.lower())]
            found = words[0] if len(words) == 1 else (sum(w[0] for w in words), " ".join(w[1] for w in words), " ".join(w[2] for w in words))
        else:
            found = self._coded(self.ids(part))
        if len(part) < LONGEST:
            self[part] = found
        return found

    def coded(self, text: str) -> tuple[int, str, str]:
        """How many ids ``text`` has, and SHA-256 of the ids as text and of the decoded text."""
        parts = list(filter(None, _SPACES.sub(" ", text.replace("\n", " ")).split(" ")))
        found = [x for x in map(self.__getitem__, parts) if x[0]]
        ids, decoded = " ".join([x[1] for x in found]), " ".join([x[2] for x in found])
        return sum([x[0] for x in found]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(2)
def coder(path: str, lookahead: int) -> Coder:
    """The coder of this worker."""
    return Coder(vocabulary(path), lookahead)


def _code(batches: Iterable, path: str, lookahead: int) -> Iterator[pa.RecordBatch]:
    coded = coder(path, lookahead).coded
    yield from batches_of(((doc_id, *coded(text)) for doc_id, text in rows_of(batches)), CODED)


def encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every text, encoded and decoded again."""
    small_batches(docs.sparkSession)
    step = partial(_code, path=tokenizer, lookahead=vocabulary(tokenizer).lookahead())
    return texts(docs).mapInArrow(step, ddl(CODED))
