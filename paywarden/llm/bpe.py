"""Byte-level BPE encoding and decoding as a reduction up a tree.

Token sequences of a fixed vocabulary are a monoid: `join` gives the encoding of
two neighbouring byte strings from their encodings. A sequence is the encoding of
its bytes exactly if each adjacent pair of tokens is the encoding of its own bytes
(the tokens are then stable). So `join` re-encodes a window over the boundary and
moves its rims outwards until the pairs there are stable; all tokens outside are then
proved right. A text is cut by the pattern, each match is halved
down to bytes and joined upwards, and matches are concatenated. Decoding
concatenates halves up the same kind of tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paywarden.llm.storage import schema_of, unused

CACHE_WORDS = 250_000  # matches in a generation of the cache of a worker
LONG_MATCH = 64  # characters; longer matches are not kept
CACHE_PIECES = 200_000  # short halves and token pairs kept likewise
BATCH_ROWS = 500  # texts whose ids are returned together
SHORT = 6  # bytes of a half that is worth keeping
FEW = 64  # bytes of a window that are merged without a heap


class Vocabulary:
    """Ranks of a vocabulary file, and the monoid over its tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self._pairs: dict[int, list[int] | None] = {}
        self._halves: dict[bytes, list[int]] = {}

    def merged(self, data: bytes) -> list[int]:
        """Merge neighbours by lowest rank, the leftmost first, until none can be merged."""
        if len(data) > FEW:
            return self._merged_many(data)
        rank_of, none = self.ranks.get, len(self.tokens)
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = [rank_of(data[i : i + 2], none) for i in range(len(data) - 1)]
        while ranks and (best := min(ranks)) != none:
            at = ranks.index(best)
            parts[at : at + 2] = [self.tokens[best]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of(parts[at] + parts[at + 1], none)
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] + parts[at], none)
        return [self.ranks[p] for p in parts]

    def _merged_many(self, data: bytes) -> list[int]:
        """The same with a heap of (rank, start) and the ends of parts, for n log n steps."""
        rank_of, n = self.ranks.get, len(data)
        end = list(range(1, n + 1))  # by start of a part; 0 if none starts there any more
        start = list(range(n))  # by end of a part, less one
        waiting = [(rank, i) for i in range(n - 1) if (rank := rank_of(data[i : i + 2])) is not None]
        heapq.heapify(waiting)
        while waiting:
            rank, first = heapq.heappop(waiting)
            middle = end[first]
            if not middle or middle == n or rank_of(data[first : end[middle]]) != rank:
                continue
            last = end[middle]
            end[first], end[middle], start[last - 1] = last, 0, first
            if last < n and (rank := rank_of(data[first : end[last]])) is not None:
                heapq.heappush(waiting, (rank, first))
            if first and (rank := rank_of(data[start[first - 1] : last])) is not None:
                heapq.heappush(waiting, (rank, start[first - 1]))
        return [self.ranks[data[i : end[i]]] for i in range(n) if end[i]]

    def _window(self, ids: list[int]) -> list[int]:
        return self.merged(b"".join([self.tokens[t] for t in ids]))

    def changed(self, left: int, right: int) -> list[int] | None:
        """The encoding of two neighbouring tokens, or None if it is these two: the pair is stable."""
        pair = left * len(self.tokens) + right
        known = self._pairs.get(pair, pair)
        if known == pair:
            if len(self._pairs) >= CACHE_PIECES:
                self._pairs.clear()
            known = self._window([left, right])
            known = self._pairs[pair] = None if known == [left, right] else known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two byte strings together.

        While the pair at the boundary is not stable, its encoding takes its place, with
        a window to the left that doubles until it ends in a stable pair, and the
        boundary moves on by a token.
        """
        if not left or not right:
            return left + right
        out = left
        for at, token in enumerate(right):
            window = self.changed(out[-1], token)
            if window is None:
                return out + right[at:]
            if out is left:
                out = left.copy()  # it may be kept for another text
            out.pop()
            wide = 1
            while out and self.changed(out[-1], window[0]) is not None:
                window = self._window(out[-wide:] + window)
                del out[-wide:]
                wide *= 2
            out += window
        return out

    def encoded(self, data: bytes) -> list[int]:
        """Tokens of a byte string, by halves."""
        if len(data) <= 1:
            return [self.ranks[data]] if data else []
        short = len(data) <= SHORT
        if short and (known := self._halves.get(data)) is not None:
            return known
        middle = len(data) // 2
        out = self.join(self.encoded(data[:middle]), self.encoded(data[middle:]))
        if short:
            if len(self._halves) >= CACHE_PIECES:
                self._halves.clear()
            self._halves[data] = out
        return out

    def match(self, text: str) -> list[int]:
        """Tokens of one match of the pattern. A match that is a token is that token."""
        data = text.encode("utf-8")
        whole = self.ranks.get(data)
        return self.encoded(data) if whole is None else [whole]

    def decoded(self, ids: list[int]) -> bytes:
        """Bytes of tokens, concatenated up a tree."""
        if len(ids) <= 4096:
            return b"".join([self.tokens[t] for t in ids])
        middle = len(ids) // 2
        return self.decoded(ids[:middle]) + self.decoded(ids[middle:])


class _Packed(dict):
    """Packed ids of matches, made on demand. Two generations of bounded size are kept."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.older = vocabulary, {}
        self.numbers = [rank.to_bytes(4, "little") for rank in range(len(vocabulary.tokens))]

    def __missing__(self, match: str) -> bytes:
        packed = self.older.get(match)
        if packed is None:
            packed = b"".join([self.numbers[t] for t in self.vocabulary.match(match)])
        if len(match) <= LONG_MATCH:
            if len(self) >= CACHE_WORDS:
                self.older = dict(self)
                self.clear()
            self[match] = packed
        return packed


# The letters and numbers that version 16 of Unicode added, first and last of
# each span. The libraries know them; the tables of Python 3.13 are of version 15.1.
ADDED_LETTERS = """
1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d4a-10d65 10d6f-10d85 10ec2-10ec4 11380-11389 1138b-1138b
1138e-1138e 11390-113b5 113b7-113b7 113d1-113d1 113d3-113d3 11bc0-11be0 13460-143fa 16100-1611d
16d40-16d6c 18cff-18cff 1e5d0-1e5ed 1e5f0-1e5f0
"""
ADDED_NUMBERS = "10d40-10d49 116d0-116e3 11bf0-11bf9 16130-16139 16d70-16d79 1ccf0-1ccf9 1e5f1-1e5fa"


def _codes(spans: str) -> frozenset[int]:
    ends = ([int(x, 16) for x in span.split("-")] for span in spans.split())
    return frozenset(code for first, last in ends for code in range(first, last + 1))


_ADDED = {"L": _codes(ADDED_LETTERS), "N": _codes(ADDED_NUMBERS)}


def belongs(code: int, initial: str) -> bool:
    """Whether the general category of a character starts with `initial`, L for letters or N for numbers."""
    return unicodedata.category(chr(code))[0] == initial or code in _ADDED[initial]


def _class_of(initial: str) -> str:
    """Body of a character class with all characters of 16 bits in a category."""
    spans: list[list[int]] = []
    for code in range(0x10000):
        if belongs(code, initial):
            if spans and spans[-1][1] == code - 1:
                spans[-1][1] = code
            else:
                spans.append([code, code])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in spans)


# The characters with the Unicode property White_Space.
WHITE_SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def standard_pattern(pattern: str) -> re.Pattern:
    """The pattern for Python's own, faster engine: its classes are written out for characters of 16 bits."""
    letters, numbers = _class_of("L"), _class_of("N")
    inner = re.sub(
        r"\[\^([^\]]*)\]",
        lambda m: "[^" + m[1].replace(r"\s", WHITE_SPACE).replace(r"\p{L}", letters).replace(r"\p{N}", numbers) + "]",
        pattern,
    )
    for name, body in ((r"\p{L}", letters), (r"\p{N}", numbers), (r"\S", "^" + WHITE_SPACE), (r"\s", WHITE_SPACE)):
        # What is left stands outside of brackets.
        outside = re.split(r"(\[[^\]]*\])", inner)
        inner = "".join(x if k % 2 else x.replace(name, f"[{body}]") for k, x in enumerate(outside))
    return re.compile(inner)


class _Standins(dict):
    """For str.translate: characters beyond 16 bits become a letter, number or sign of 16 bits. None of them is white space."""

    def __missing__(self, code: int) -> int:
        small = code if code < 0x10000 else 0xAA if belongs(code, "L") else 0xB2 if belongs(code, "N") else 0xA4
        self[code] = small
        return small


class Cutter:
    """Cuts texts into the matches of a pattern."""

    def __init__(self, pattern: str):
        self.pattern, self.standins = standard_pattern(pattern), _Standins()

    def matches(self, text: str) -> list[str]:
        if text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.standins))]


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a token in base 64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encodes and decodes texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.cutter = Cutter(pattern)
        self.vocabulary = Vocabulary(ranks)
        self._packed = _Packed(self.vocabulary)

    def encoded(self, text: str) -> bytes:
        """Ids of a text, packed."""
        return b"".join(map(self._packed.__getitem__, self.cutter.matches(text)))

    def decoded(self, data: bytes) -> bytes:
        """UTF-8 bytes of packed ids."""
        return self.vocabulary.decoded(np.frombuffer(data, dtype="<u4").tolist())


_WORKER: dict[int, Codec] = {}


def _codec(key: int, ranks: dict[bytes, int], pattern: str) -> Codec:
    """The codec of this worker; a reused worker has it ready."""
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Codec(ranks, pattern)
    return _WORKER[key]


def encode_frame(docs: DataFrame, ranks: dict[bytes, int], pattern: str, kept: list[str], ids: bool = True) -> DataFrame:
    """The columns `kept`, then n_tokens, ids_sha256, decoded_sha256, decoded_equal and, on demand, `ids`.

    `ids` are unsigned 32-bit little-endian numbers in one binary value; the hashes
    are over those bytes and over the decoded text. Null text is empty, an empty
    text has no ids, an empty table gives no rows, repeated rows come out repeated.
    Whole texts are encoded, however long. A kept column that is named like a new
    one is an error; all others may have any name.
    """
    new = "n_tokens long, ids_sha256 string, decoded_sha256 string, decoded_equal boolean" + ", ids binary" * ids
    fields = [docs.schema[c] for c in kept]
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary: about 50,000 entries
    key = hash((pattern, frozenset(ranks.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(key, shared.value, pattern)
        for batch in (whole.slice(at, BATCH_ROWS) for whole in batches for at in range(0, whole.num_rows, BATCH_ROWS)):
            columns: list[list] = [[] for _ in range(4 + ids)]
            texts = batch.column(batch.num_columns - 1)
            for value in texts:
                text = value.as_py() or ""
                data = codec.encoded(text)
                back = codec.decoded(data)
                row = (
                    len(data) // 4,
                    hashlib.sha256(data).hexdigest(),
                    hashlib.sha256(back).hexdigest(),
                    back == text.encode("utf-8"),
                    data,
                )
                for column, x in zip(columns, row):
                    column.append(x)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=[*batch.schema.names[:-1], "n_tokens", "ids_sha256", "decoded_sha256", "decoded_equal", *["ids"][:ids]],
            )

    source = docs.select(*(docs[f"`{f.name}`"] for f in fields), docs["text"].cast("string").alias(unused(docs, "_text")))
    return source.mapInArrow(run, schema_of(fields, new))
