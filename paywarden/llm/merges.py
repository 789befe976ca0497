"""BPE by a priority queue: the encoding and decoding of a byte-level tokenizer file.

The symbols of a match are a doubly linked list of token ids, at first one for each
byte. A queue holds (merge rank, position) for neighbours that can be merged; the
lowest rank goes first, then the leftmost. Entries are never taken out of the queue:
one that no longer describes the neighbours at its position is stale and skipped. A
merge costs one step of the queue, so a match of n bytes takes n log n steps, however
long it is. Decoding concatenates the vocabulary's strings.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paywarden.llm.bpe import Cutter
from paywarden.llm.storage import schema_of, unused

CACHE_WORDS = 400_000  # matches in a generation of the cache of a worker
LONG_MATCH = 64  # characters; longer matches are not kept
BATCH_ROWS = 500  # texts whose ids are returned together


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    A byte that is a visible character of Latin-1 stands for itself, the others are
    numbered on from 256.
    """
    visible = [33 <= b <= 126 or 161 <= b <= 255 and b != 173 for b in range(256)]
    hidden = iter(range(256, 512))
    return [chr(b) if seen else chr(next(hidden)) for b, seen in enumerate(visible)]


@dataclass(frozen=True)
class Tokenizer:
    """What a byte-level tokenizer file says: tokens by id as bytes, merges in order, and whole strings that are tokens."""

    tokens: dict[int, bytes]
    merges: list[tuple[bytes, bytes]]
    added: dict[str, int]


def read_tokenizer(path: str) -> Tokenizer:
    """A tokenizer file in JSON. A file that asks for more than byte-level BPE is refused."""
    with open(path, encoding="utf-8") as source:
        said = json.load(source)
    model, cut = said["model"], said["pre_tokenizer"] or {}
    plain = (
        model.get("type") == "BPE"
        and said["normalizer"] is None
        and cut.get("type") == "ByteLevel"
        and not cut.get("add_prefix_space")
        and cut.get("use_regex")
        and (said["decoder"] or {}).get("type") == "ByteLevel"
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        and not any(t[k] for t in said["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if not plain:
        raise ValueError(f"not a plain byte-level BPE tokenizer: {path}")
    byte = {letter: b for b, letter in enumerate(byte_letters())}
    raw = lambda token: bytes(byte[c] for c in token)
    added = {t["content"]: t["id"] for t in said["added_tokens"]}
    tokens = {i: raw(t) for t, i in model["vocab"].items() if t not in added}
    tokens |= {i: t.encode("utf-8") for t, i in added.items()}
    pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    return Tokenizer(tokens, [(raw(a), raw(b)) for a, b in pairs], added)


class Merger:
    """Ids of matches by the merges of a tokenizer."""

    def __init__(self, tokenizer: Tokenizer):
        ids = {token: i for i, token in tokenizer.tokens.items() if i not in tokenizer.added.values()}
        self.single = [ids[bytes([b])] for b in range(256)]
        ranks: list[dict[int, int]] = [{} for _ in range(max(tokenizer.tokens) + 1)]
        self.made = []
        for rank, (a, b) in enumerate(tokenizer.merges):
            ranks[ids[a]][ids[b]] = rank
            self.made.append(ids[a + b])
        self.rank_with = [of_left.get for of_left in ranks]  # by id of the left one

    def encoded(self, data: bytes) -> list[int]:
        """Token ids of one match. An entry of the queue is rank * n + position, for a match of n bytes."""
        single, rank_with, made_of = self.single, self.rank_with, self.made
        symbols = [single[b] for b in data]
        n = len(symbols)
        queue = [
            rank * n + at
            for at, (left, right) in enumerate(zip(symbols, symbols[1:]))
            if (rank := rank_with[left](right)) is not None
        ]
        if not queue:
            return symbols
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        following, preceding = list(range(1, n + 1)), list(range(-1, n - 1))
        symbols.append(-1)  # behind the last one; -1 also marks what was merged into its left neighbour
        while queue:
            rank, at = divmod(pop(queue), n)
            if symbols[at] < 0:
                continue  # stale: gone
            right = following[at]
            now = rank_with[symbols[at]](symbols[right])
            if now != rank and (now is None or made_of[now] != made_of[rank]):
                continue  # stale: other neighbours by now
            symbols[at] = made = made_of[rank]
            symbols[right] = -1
            following[at] = after = following[right]
            if after < n:
                preceding[after] = at
                if (rank := rank_with[made](symbols[after])) is not None:
                    push(queue, rank * n + at)
            before = preceding[at]
            if before >= 0 and (rank := rank_with[symbols[before]](made)) is not None:
                push(queue, rank * n + before)
        return [s for s in symbols if s >= 0]


class _Packed(dict):
    """Packed ids of matches, made on demand. Two generations of bounded size are kept."""

    def __init__(self, merger: Merger):
        super().__init__()
        self.merger, self.older = merger, {}

    def __missing__(self, match: str) -> bytes:
        packed = self.older.get(match)
        if packed is None:
            ids = self.merger.encoded(match.encode("utf-8"))
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(match) <= LONG_MATCH:
            if len(self) >= CACHE_WORDS:
                self.older = dict(self)
                self.clear()
            self[match] = packed
        return packed


class Coder:
    """Encodes and decodes whole texts."""

    def __init__(self, tokenizer: Tokenizer, pattern: str):
        self.cut = Cutter(pattern).matches
        self._packed = _Packed(Merger(tokenizer))
        size = max(tokenizer.tokens) + 1
        self.tokens = [tokenizer.tokens.get(i, b"") for i in range(size)]
        self.decimals = [b"%d" % i for i in range(size)]
        self.added = {text: i.to_bytes(4, "little") for text, i in tokenizer.added.items()}
        longest = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.whole = re.compile(f"({'|'.join(longest)})") if longest else None

    def encoded(self, text: str) -> np.ndarray:
        """Ids of a text. A string that is a token as a whole is found first; what lies between is cut by the pattern."""
        if self.whole is None or not any(a in text for a in self.added):
            packed = map(self._packed.__getitem__, self.cut(text))
        else:
            packed = []
            for k, part in enumerate(self.whole.split(text)):
                packed += [self.added[part]] if k % 2 else map(self._packed.__getitem__, self.cut(part))
        return np.frombuffer(b"".join(packed), dtype="<u4")

    def decoded(self, ids: list[int]) -> str:
        """Text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")


_WORKER: dict[int, Coder] = {}


def _coder(key: int, tokenizer: Tokenizer, pattern: str) -> Coder:
    """The coder of this worker; a reused worker has it ready."""
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Coder(tokenizer, pattern)
    return _WORKER[key]


def encode_frame(docs: DataFrame, tokenizer: Tokenizer, pattern: str, kept: list[str], ids: bool = True) -> DataFrame:
    """The columns `kept`, then n_tokens, ids_sha256, decoded_sha256, decoded_equal and, on demand, `ids`.

    `ids` is an array of int; ids_sha256 is over the decimal ids joined by commas,
    decoded_sha256 over the decoded text in UTF-8. Null text is empty, an empty text
    has no ids, an empty table gives no rows, repeated rows come out repeated. Whole
    texts are encoded, however long, and a match takes n log n steps. A kept column
    that is named like a new one is an error; all others may have any name.
    """
    new = "n_tokens long, ids_sha256 string, decoded_sha256 string, decoded_equal boolean" + ", ids array<int>" * ids
    fields = [docs.schema[c] for c in kept]
    clash = {f.name for f in fields} & {f.name for f in schema_of([], new).fields}
    if clash:
        raise ValueError(f"columns named like results: {sorted(clash)}")
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)  # a vocabulary: about 50,000 entries
    key = hash((pattern, frozenset(tokenizer.tokens.items()), tuple(tokenizer.merges), frozenset(tokenizer.added.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(key, shared.value, pattern)
        for batch in (whole.slice(at, BATCH_ROWS) for whole in batches for at in range(0, whole.num_rows, BATCH_ROWS)):
            columns: list[list] = [[] for _ in range(4 + ids)]
            for value in batch.column(batch.num_columns - 1):
                text = value.as_py() or ""
                found = coder.encoded(text)
                listed = found.tolist()
                back = coder.decoded(listed)
                decimal = b",".join(map(coder.decimals.__getitem__, listed))
                row = (
                    len(listed),
                    hashlib.sha256(decimal).hexdigest(),
                    hashlib.sha256(back.encode("utf-8")).hexdigest(),
                    back == text,
                    found.astype("<i4"),
                )
                for column, x in zip(columns, row):
                    column.append(x)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=[*batch.schema.names[:-1], "n_tokens", "ids_sha256", "decoded_sha256", "decoded_equal", *["ids"][:ids]],
            )

    source = docs.select(*(docs[f"`{f.name}`"] for f in fields), docs["text"].cast("string").alias(unused(docs, "_text")))
    return source.mapInArrow(run, schema_of(fields, new))
