"""Benchmark decontamination with an FM-index for each training shard.

A task cuts its documents into shards. The words of a shard are numbered by the
benchmark's vocabulary; runs of such words that are long enough to hold a window
are joined with separators into one text, for which suffix array, Burrows-Wheeler
transform and its wavelet matrix are built. All windows are searched backwards at
once through wavelet ranks, their occurrences located by walking to the next
sampled suffix, and the spans merged for each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywarden.llm.storage import schema_of, written
from paywarden.llm.words import ALNUM, LOWER, text_slices, word_spans

WINDOW = 10  # words
SHARD_BYTES = 8 << 20  # of text in one index; a longer text is a shard of its own
SAMPLE = 8  # every so many positions of the text have their suffix position kept
BLOCK_BYTES = 4 << 20  # of benchmark text searched in one pass

_SPACED = LOWER.copy()
_SPACED[~ALNUM] = 32
_SPACED = _SPACED.tobytes()


def split_words(data: bytes) -> list[bytes]:
    """Words of a text: ASCII letters (lower-cased) and digits, and all other characters beyond ASCII."""
    return data.translate(_SPACED).split()


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in order, by doubling. The end sorts before every symbol."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while True:
        key = rank * (n + 2)
        key[: max(n - step, 0)] += rank[step:]
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.empty(n, dtype=np.int64)
        fresh[order] = np.concatenate([[1], 1 + np.cumsum(key[1:] != key[:-1])])
        if n == 0 or fresh[order[-1]] == n:
            return order
        rank, step = fresh, 2 * step


class FmIndex:
    """Search in a sequence of symbols 1 to `most`, in which 0 separates.

    Inside, all symbols are one larger, and a single 0 ends the text: the walk from a
    row to the row of the position before needs an end that occurs once.
    """

    def __init__(self, text: np.ndarray, most: int):
        text, most = np.concatenate([text + 1, [0]]).astype(np.int64), most + 1
        order = suffix_array(text)
        self.size, self.bits = len(text), int(most).bit_length()
        last = text[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=most + 1))])
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (last >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(self.size - int(self.ones[-1][-1]))
            last = np.concatenate([last[bit == 0], last[bit == 1]])
        marked = order % SAMPLE == 0
        self.marks = np.concatenate([[0], np.cumsum(marked)])
        self.sampled = order[marked]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol is among the first `at` of the transform."""
        start = np.zeros_like(at)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbol >> (self.bits - 1 - k)) & 1 == 1
            start = np.where(bit, zeros + ones[start], start - ones[start])
            at = np.where(bit, zeros + ones[at], at - ones[at])
        return at - start

    def symbol(self, at: np.ndarray) -> np.ndarray:
        """The symbols of the transform at some rows."""
        out = np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros):
            bit = ones[at + 1] - ones[at]
            out = 2 * out + bit
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
        return out

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each phrase; a phrase ends at its length."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((lengths > k) & (high > low))
            symbol = phrases[live, k].astype(np.int64) + 1
            low[live] = self.before[symbol] + self.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        out, steps = np.full(len(rows), -1, np.int64), np.zeros(len(rows), np.int64)
        todo, rows = np.arange(len(rows)), rows.copy()
        while len(todo):
            known = self.marks[rows + 1] > self.marks[rows]
            out[todo[known]] = self.sampled[self.marks[rows[known]]] + steps[todo[known]]
            todo, rows = todo[~known], rows[~known]
            symbol = self.symbol(rows)
            rows = self.before[symbol] + self.rank(symbol, rows)
            steps[todo] += 1
        return out


class Windows:
    """The distinct windows of benchmark texts, as numbers of words, and the items that each is of."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        self.items = [item for item, _ in items]
        rows, lengths, owners = [], [], []
        for k, (_, text) in enumerate(items):
            words = split_words((text or "").encode("utf-8"))
            ids = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words], dtype=np.int32)
            if 0 < len(ids) < window:
                rows.append(np.pad(ids, (0, window - len(ids)))[None])
            elif len(ids):
                rows.append(np.lib.stride_tricks.sliding_window_view(ids, window))
            if len(ids):
                lengths.append(np.full(len(rows[-1]), min(len(ids), window)))
                owners.append(np.full(len(rows[-1]), k))
        if not rows:
            rows, lengths, owners = [np.zeros((0, window), np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        self.phrases, at, same = np.unique(np.concatenate(rows), axis=0, return_index=True, return_inverse=True)
        self.lengths = np.concatenate(lengths)[at]
        pairs = np.unique(np.stack([same.ravel(), np.concatenate(owners)], axis=1), axis=0)
        self._owners, self._first = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(self.phrases) + 1))
        self.shortest = int(self.lengths.min()) if len(self.lengths) else 0

    def owners(self, window: int) -> list[str]:
        return [self.items[k] for k in self._owners[self._first[window] : self._first[window + 1]]]


def shard_hits(texts: list[bytes], windows: Windows) -> list[tuple[int, list[tuple[int, int]], set]]:
    """For each text its number of words, the merged spans of hit words, and the items that occur in it."""
    parts, bases, sizes = [], [], []  # runs of known words, where they stand among all words, words of each text
    at = 0
    for text in texts:
        words = split_words(text)
        sizes.append(len(words))
        if windows.shortest and len(words) >= windows.shortest:
            ids = np.fromiter((windows.numbers.get(w, 0) for w in words), np.int64, len(words))
            edges = np.diff(np.concatenate([[0], ids != 0, [0]]).astype(np.int8))
            starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            for s, e in zip(starts.tolist(), stops.tolist()):
                if e - s >= windows.shortest:
                    parts.append(np.concatenate([ids[s:e], [0]]))
                    bases.append(at + s)
        at += len(words)
    firsts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    found: list[set] = [set() for _ in texts]
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    if parts:
        joined = np.concatenate(parts)
        begins = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]])
        index = FmIndex(joined, len(windows.numbers))
        low, high = index.search(windows.phrases, windows.lengths)
        counts = high - low
        which = np.repeat(np.arange(len(low)), counts)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + low[which]
        places = index.locate(rows)
        run = np.searchsorted(begins, places, "right") - 1
        places = places - begins[run] + np.array(bases)[run]
        owner = np.searchsorted(firsts, places, "right") - 1
        hit = np.zeros(at + 1, dtype=np.int64)
        np.add.at(hit, places, 1)
        np.add.at(hit, places + windows.lengths[which], -1)
        covered = np.cumsum(hit[:-1]) > 0
        for w, d in np.unique(np.stack([which, owner], axis=1), axis=0).tolist():
            found[d].update(windows.owners(w))
        for d in np.unique(owner).tolist():
            edges = np.diff(np.concatenate([[0], covered[firsts[d] : firsts[d + 1]], [0]]).astype(np.int8))
            spans[d] = list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))
    return list(zip(sizes, spans, found))


def benchmark_blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[tuple[list[tuple[str, str | None]], bool]]:
    """The items, block by block, each of about `limit` bytes, and whether a block is the last: the query set is
    passed over the documents in blocks, and the driver holds one at a time. Repeated items are one."""
    name = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    items = benchmark.select(name.alias("item"), F.col("text").cast("string").alias("text")).distinct()
    size = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    blocks = int(size // limit) + 1
    if blocks > 1:
        items = written(items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks))))
    for k in range(blocks):
        rows = (items.where(F.col("block") == k) if blocks > 1 else items).collect()
        yield [(r["item"], r["text"]) for r in rows], k == blocks - 1


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    data = np.frombuffer(text, dtype=np.uint8)
    starts, stops, _ = word_spans(data, np.array([0, len(data)]), ALNUM)
    kept, at = [], 0
    for first, last in spans:
        kept.append(text[at : starts[first]])
        at = stops[last - 1]
    return b"".join([*kept, text[at:]])


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def contamination(
    docs: DataFrame, benchmark: DataFrame, kept: list[str], window: int = WINDOW, clean: bool = False
) -> DataFrame:
    """The columns `kept`, then _n_words, _spans of hit words (start, end), _items that occur, and with `clean`
    also _text without the spans, for each document.

    Null texts have no words; a benchmark item without words has no window; a null
    item_id is the empty name; empty tables give no rows or no hits; repeated rows
    come out repeated. A hit occurrence counts once however many items share it. Of a
    benchmark of several blocks, each is broadcast, its hits written to a table, and released
    before the next.
    """
    fields = [f for f in docs.schema.fields if f.name in kept]
    span = pa.struct([("s", pa.int32()), ("e", pa.int32())])
    kinds = {"_n_words": pa.int64(), "_spans": pa.list_(span), "_items": pa.list_(pa.string()), "_text": pa.string()}
    declared = {"_n_words": "long", "_spans": "array<struct<s: int, e: int>>", "_items": "array<string>", "_text": "string"}
    context = docs.sparkSession.sparkContext
    frame = docs.select(*(F.col(f"`{f.name}`") for f in fields), docs["text"].cast("string").alias("_text"))
    for k, (block, last) in enumerate(benchmark_blocks(benchmark)):
        shared = context.broadcast(Windows(block, window))  # a block
        names = ["_n_words", "_spans", "_items"] + ["_text"] * (clean or not last)

        def run(
            batches: Iterator[pa.RecordBatch], shared=shared, first=k == 0, last=last, names=names
        ) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column(batch.schema.names.index("_text"))
                found, texts = [], []
                for _, data, offsets in text_slices(column, SHARD_BYTES):
                    part = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                    found += shard_hits(part, shared.value)
                    texts += part if "_text" in names else []
                spans, items = [x for _, x, _ in found], [x for _, _, x in found]
                if not first:
                    known = batch.column(batch.schema.names.index("_spans")).to_pylist()
                    spans = [_merged(x + [(y["s"], y["e"]) for y in old]) for x, old in zip(spans, known)]
                    known = batch.column(batch.schema.names.index("_items")).to_pylist()
                    items = [x | set(old) for x, old in zip(items, known)]
                if clean and last:
                    texts = [cut(t, x) if x else t for t, x in zip(texts, spans)]
                new = {
                    "_n_words": [n for n, _, _ in found],
                    "_spans": [[{"s": s, "e": e} for s, e in x] for x in spans],
                    "_items": [sorted(x) for x in items],
                    "_text": [t.decode("utf-8") if v else None for t, v in zip(texts, column.is_valid().to_pylist())],
                }
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in range(len(fields))), *(pa.array(new[n], kinds[n]) for n in names)],
                    names=[*(f.name for f in fields), *names],
                )

        frame = frame.mapInArrow(run, schema_of(fields, ", ".join(f"{n} {declared[n]}" for n in names)))
        if not last:
            frame = written(frame)
            shared.destroy()
    return frame


def cleaned(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, all their columns, with the hit spans cut out of `text`. A null text stays null."""
    others = [c for c in docs.columns if c != "text"]
    plain = docs.select(*(docs[f"`{c}`"].alias(f"c{k}") for k, c in enumerate(others)), docs["text"])  # names that cannot clash
    found = contamination(plain, benchmark, [f"c{k}" for k in range(len(others))], window, clean=True)
    places = {c: f"c{k}" for k, c in enumerate(others)} | {"text": "_text"}
    return found.select(*(F.col(places[c]).alias(c) for c in docs.columns))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, for each document."""
    found = contamination(docs, benchmark, ["doc_id"], window)
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    return found.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("_items"), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
