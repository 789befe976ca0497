"""Removal of repeated passages by suffix arrays, sorted in two stages.

Every byte goes that lies in a string of `length` bytes which also starts elsewhere
in the corpus. One suffix array over all documents would not fit one task, so the
windows (strings of `length` bytes) are dealt out by content first: the anchor of a
window is its k-gram with the smallest hash, the leftmost of equals. Equal windows
have equal anchors, so each can only repeat among the windows of its anchor.

Neighbouring windows with the same anchor are one context: a stretch of text that
holds them all. Anchors that occur once are dropped; equal contexts are merged with
their count; the different contexts of an anchor are put side by side, and a suffix
array over them, with the common prefixes of neighbours, shows which windows repeat.

The contexts of an anchor with very many of them would be too large for one suffix array.
Its windows hold the anchor and are told apart by the bytes beside it, so such an anchor
is made longer: windows with enough bytes after it take half of the missing bytes there,
all others take them in front. A context becomes two shorter ones, equal ones are merged
again, and what is alone with its longer anchor goes. This is repeated for anchors that
still have very many; after a few rounds an anchor would be the whole window.

A key that holds more than an even part of the rows is joined where its rows lie, from a
broadcast list that is no longer than the shuffle is wide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.llm.storage import schema_of, written
from paywarden.llm.words import mix, text_slices

LENGTH = 200
GRAM = 64  # bytes of an anchor; a longer one is less often met twice by chance
CHUNK = 1 << 20  # windows of a text looked at together; positions must fit 24 bits
BUCKET_BYTES = 1 << 20  # of contexts in one suffix array
HOT_CONTEXTS = 4_096  # different contexts of an anchor, beyond which it is made longer

_BYTE = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x51ED270B))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, width: int = GRAM) -> np.ndarray:
    """A hash of the `width` bytes from each position on."""
    out, have = None, 0  # hashes of the lowest bits of `width` so far
    level, size, power = _BYTE[data], 1, int(_STEP)
    while True:
        if width & size:
            if out is None:
                out, have = level, size
            else:  # the longer part stands in front
                m = len(data) - size - have + 1
                factor = np.uint64(pow(int(_STEP), have, 1 << 64))
                out, have = level[:m] * factor + out[size : size + m], have + size
        if size * 2 > width:
            break
        level = level[: len(level) - size] * np.uint64(power) + level[size:]
        size, power = size * 2, power * power % (1 << 64)
    return mix(out)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` neighbours."""
    size = 1
    while size * 2 <= width:
        values, size = np.minimum(values[: len(values) - size], values[size:]), size * 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text, first window, number of windows, anchor hash) of each context, windows counted in the text."""
    found = []
    for first in range(0, max(1, len(data) - length + 1), CHUNK):
        part = data[first : first + CHUNK + length - 1]
        if len(part) < length:
            continue
        hashes = gram_hashes(part)
        packed = hashes & ~np.uint64((1 << 24) - 1) | np.arange(len(hashes), dtype=np.uint64)
        anchor = (window_minima(packed, length - GRAM + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
        at = np.arange(first, first + len(anchor))
        owner = np.searchsorted(offsets, at, "right") - 1
        whole = at + length <= offsets[np.minimum(owner + 1, len(offsets) - 1)]
        at, owner, anchor = at[whole], owner[whole], anchor[whole]
        if not len(at):
            continue
        new = np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(at) != 1) | (np.diff(owner) != 0)])
        starts = np.flatnonzero(new)
        counts = np.diff(np.append(starts, len(at)))
        found.append((owner[starts], at[starts] - offsets[owner[starts]], counts, hashes[anchor[starts]]))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found))


def _eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as numbers in the order of the bytes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.as_strided(padded[:8].view(">u8"), shape=(len(data) + 1,), strides=(1,)).astype(np.uint64)


def two_stage_order(data: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of the stretches that end at `ends`, in order of their first `depth` bytes.

    Directly sorted are the suffixes smaller than their successors. All others are
    put in place by going through the buckets of first bytes in order: the suffix one
    byte before a placed one comes next in the bucket of that byte.
    """
    n = len(data)
    last = np.zeros(n, dtype=bool)
    last[ends - 1] = True
    # A suffix is larger than its successor if its byte is, or if it is at the end; equal bytes inherit.
    above = np.zeros(n, dtype=np.int8)
    above[:-1] = np.sign(data[:-1].astype(np.int16) - data[1:])
    above[last] = 1
    decided = np.where(above != 0, np.arange(n), n)
    larger = above[np.minimum.accumulate(decided[::-1])[::-1]] > 0
    eights = _eights(data)
    stop = np.repeat(ends, np.diff(np.concatenate([[0], ends])))

    masks = np.array([((1 << 8 * k) - 1) << (64 - 8 * k) for k in range(9)], dtype=np.uint64)

    def keys(at: np.ndarray) -> np.ndarray:
        """8 bytes from each position; those past the stretch are 0."""
        return eights[np.minimum(at, n)] & masks[np.clip(stop[np.minimum(at, n - 1)] - at, 0, 8)]

    smaller = np.flatnonzero(~larger)
    order = smaller[np.argsort(keys(smaller), kind="stable")]
    key = keys(order)
    group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) if len(order) else order
    for at in range(8, depth, 8):
        # Only ties go on.
        same = np.zeros(len(order), dtype=bool)
        equal = group[1:] == group[:-1]
        same[1:] |= equal
        same[:-1] |= equal
        places = np.flatnonzero(same)
        if not len(places):
            break
        tied = order[places]
        key = np.where(tied + at < stop[tied], keys(tied + at), np.uint64(0))
        inner = np.lexsort((key, group[places]))
        order[places] = tied[inner]
        key, old = key[inner], group[places]
        fresh = np.zeros(len(order), dtype=np.int64)
        fresh[places[1:]] = (key[1:] != key[:-1]) & (old[1:] == old[:-1])
        group = group + np.cumsum(fresh)
    cuts = np.searchsorted(data[order], np.arange(257))

    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    ending = np.flatnonzero(last)
    for byte in np.unique(data[ending]).tolist():
        waiting[byte].append(ending[data[ending] == byte])
    begins = np.zeros(n, dtype=bool)
    begins[np.concatenate([[0], ends[:-1]])] = True
    out = []
    for byte in range(256):
        parts = waiting[byte]
        current = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        parts = [current]
        while len(current):  # runs of the byte itself
            before = current[~begins[current]] - 1
            current = before[larger[before] & (data[before] == byte)]
            parts.append(current)
        placed = np.concatenate([*parts, order[cuts[byte] : cuts[byte + 1]]])
        out.append(placed)
        before = placed[~begins[placed]] - 1
        before = before[larger[before] & (data[before] > byte)]
        if len(before):
            heads = data[before]
            by = np.argsort(heads, kind="stable")
            before, heads = before[by], heads[by]
            steps = np.flatnonzero(np.diff(heads)) + 1
            for piece in np.split(before, steps):
                waiting[data[piece[0]]].append(piece)
    return np.concatenate(out)


def repeated(contexts: list[bytes], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each context the ranges of its windows that occur elsewhere among the contexts."""
    data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    sizes = np.array([len(c) for c in contexts])
    ends = np.cumsum(sizes)
    order = two_stage_order(data, ends, length)
    stop = np.repeat(ends, sizes)
    order = order[stop[order] - order >= length]
    # Common prefixes of neighbours, as far as the length.
    eights = _eights(data)
    shift = np.uint64(8 * (-length % 8))
    alike = np.arange(len(order) - 1)
    for at in range(0, length, 8):
        a, b = eights[order[alike] + at], eights[order[alike + 1] + at]
        if at + 8 > length:
            a, b = a >> shift, b >> shift
        alike = alike[a == b]
    hit = np.zeros(len(data) + 1, dtype=np.int8)
    hit[order[alike]] = 1
    hit[order[alike + 1]] = 1
    out = []
    for a, b in zip((ends - sizes).tolist(), ends.tolist()):
        edges = np.diff(np.concatenate([[0], hit[a:b], [0]]))
        out.append(list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist())))
    return out


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans without overlaps; those that touch become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def cut_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])


def _texts(docs: DataFrame) -> DataFrame:
    """(k1, k2, _text): 80 bits that name a row by its id and text; rows equal in both have equal results."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(
        F.xxhash64("doc_id", text).alias("k1"), F.pmod(F.hash("doc_id", text), F.lit(1 << 16)).alias("k2"), text.alias("_text")
    )


def _context_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(k1, place, anchor, context) of each context; place packs k2, the first window and the number of windows."""
    for batch in batches:
        k1, k2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for first, data, offsets in text_slices(batch.column(2), CHUNK):
            owner, low, count, anchor = runs(data, offsets, length)
            if not len(owner):
                continue
            raw, starts = data.tobytes(), (offsets[owner] + low).tolist()
            context = [xxhash.xxh3_64_intdigest(raw[a : a + n + length - 1]) for a, n in zip(starts, count.tolist())]
            place = k2[first + owner].astype(np.int64) << 48 | low << 8 | count
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(k1[first + owner]),
                    pa.array(place),
                    pa.array(anchor.view(np.int64)),
                    pa.array(np.array(context, dtype=np.uint64).view(np.int64)),
                ],
                names=["k1", "place", "anchor", "context"],
            )


def _fetched(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(anchor, context, n, bucket, bytes) of the wanted contexts, cut from their texts."""
    per_row = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("low", "windows", "anchor", "context", "n", "bucket")).alias("cuts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            cuts, raw = batch.column(1).to_pylist(), batch.column(0).cast(pa.large_binary())
            for k, rows in enumerate(cuts):
                text = raw[k].as_py()
                out += [(x["anchor"], x["context"], x["n"], x["bucket"], text[x["low"] : x["low"] + x["windows"] + length - 1]) for x in rows]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[c] for x in out], kind) for c, kind in enumerate(kinds)], names=["anchor", "context", "n", "bucket", "bytes"]
            )

    joined = texts.join(per_row, ["k1", "k2"]).select("_text", "cuts")
    return joined.mapInArrow(cut, "anchor long, context long, n long, bucket long, bytes binary")


def _matched(rows: DataFrame, keys: list[str], some: DataFrame, large: Column) -> DataFrame:
    """`rows` joined with `some`, of which those that are `large` are few, and meet the rows without a shuffle."""
    few = F.broadcast(some.where(large))
    return rows.join(few, keys).unionByName(rows.join(few, keys, "left_anti").join(some, keys))


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, context, n, s, at, bytes) of whole contexts: the first window, and where in the bytes the anchor is."""
    for batch in batches:
        anchor, context, n, data = batch.columns
        raw = data.cast(pa.large_binary()).to_pylist()
        sizes = np.array([len(x) for x in raw], dtype=np.int64)
        if not len(sizes):
            continue
        starts = np.cumsum(sizes) - sizes
        hashes = gram_hashes(np.frombuffer(b"".join(raw), np.uint8)).view(np.int64)
        hits = np.flatnonzero(hashes == np.repeat(anchor.to_numpy(), sizes)[: len(hashes)])
        at = hits[np.searchsorted(hits, starts)] - starts
        first = pa.array(np.zeros(len(sizes), np.int64))
        yield pa.RecordBatch.from_arrays([anchor, context, n, first, pa.array(at), data], names=["anchor", "context", "n", "s", "at", "bytes"])


def halves(data: bytes, at: int, width: int, length: int) -> list[tuple[int, int, int, bytes]]:
    """(side, first window, place of the longer anchor, bytes) of the two parts of a context.

    The anchor is `width` bytes from `at`. The windows that have at least half of the other
    bytes of a window after it come first in the result, those that have them in front second.
    """
    more = (length - width + 1) // 2
    windows = len(data) - length + 1
    cut = min(max(0, at - (length - width - more)), windows)  # the first window of those that reach far enough behind
    out = []
    if cut < windows:
        out.append((0, cut, at - cut, data[cut:]))
    if cut:
        out.append((1, 0, at - more, data[: cut + length - 1]))
    return out


def _halved(batches: Iterator[pa.RecordBatch], width: int, length: int) -> Iterator[pa.RecordBatch]:
    """The parts of contexts, with the hashes of their longer anchors (longer) and of themselves (piece)."""
    wide = width + (length - width + 1) // 2
    for batch in batches:
        out: list[tuple] = []
        for anchor, context, n, s, at, data in zip(*(c.to_pylist() for c in batch.columns)):
            for side, first, place, part in halves(data, at, width, length):
                longer = xxhash.xxh3_64_intdigest(part[place : place + wide], side) - (1 << 63)
                out.append((anchor, context, n, s + first, place, part, longer, xxhash.xxh3_64_intdigest(part) - (1 << 63)))
        kinds = [*(pa.int64() for _ in range(5)), pa.binary(), pa.int64(), pa.int64()]
        names = ["anchor", "context", "n", "s", "at", "bytes", "longer", "piece"]
        yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], kind) for c, kind in enumerate(kinds)], names=names)


def _narrowed(whole: DataFrame, length: int, buckets: int, width: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Contexts (anchor, context, n, bytes) of crowded anchors, dealt out by ever longer anchors.

    Returns frames (anchor, context, n, s, bucket, bytes) for suffix arrays, and frames
    (anchor, context, s, e) of the windows that turned out equal on the way.
    """
    parts = whole.dropDuplicates(["anchor", "context"]).mapInArrow(
        _anchored, "anchor long, context long, n long, s long, at long, bytes binary"
    )
    known, sortable, equal = GRAM, [], []
    while known < length:
        def cut(batches: Iterator[pa.RecordBatch], known: int = known) -> Iterator[pa.RecordBatch]:
            return _halved(batches, known, length)

        kind = "anchor long, context long, n long, s long, at long, bytes binary, longer long, piece long"
        pieces = written(parts.mapInArrow(cut, kind))
        known += (length - known + 1) // 2
        merged = written(
            pieces.groupBy("longer", "piece").agg(
                F.sum("n").alias("n"), F.count("*").alias("rows"), F.min(F.struct("anchor", "context", "s", "at", "bytes")).alias("one")
            )
        )
        share = pieces.count() / width
        again = merged.where("n > 1").select("longer", "piece", "rows")
        windows = F.octet_length("bytes") - length + 1
        met = _matched(pieces.where("n = 1").withColumn("e", F.col("s") + windows).drop("bytes"), ["longer", "piece"], again, F.col("rows") > share)
        equal.append(met.select("anchor", "context", "s", "e"))
        crowds = merged.groupBy("longer").agg(F.count("*").alias("contexts"), F.min("n").alias("fewest")).where("contexts > 1 AND fewest = 1")
        left = written(_matched(merged, ["longer"], crowds, F.col("contexts") > share).select("longer", "contexts", "n", "one.*"))
        fits = (F.col("contexts") <= HOT_CONTEXTS) | F.lit(known >= length)
        bucket = F.pmod(F.xxhash64("longer"), F.lit(buckets)).alias("bucket")
        sortable.append(left.where(fits).select("anchor", "context", "n", "s", bucket, "bytes"))
        parts = left.where(~fits).select("anchor", "context", "n", "s", "at", "bytes")
        if parts.isEmpty():
            break
    return sortable, equal


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(k1, k2, spans) of the rows that hold repeated strings; spans are (start, end) in bytes, and may touch."""
    texts = _texts(docs)
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    anchors = written(texts.mapInArrow(lambda b: _context_rows(b, length), "k1 long, place long, anchor long, context long"))
    often = anchors.where("anchor IS NOT NULL").groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    rows = written(_matched(anchors, ["anchor"], often, F.col("n") > anchors.count() / width).drop("n"))
    contexts = written(
        rows.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.struct("k1", "place")).alias("at"))
    )
    windows, low = F.col("at.place").bitwiseAND(0xFF), F.shiftright("at.place", 8).bitwiseAND((1 << 40) - 1)
    contexts = contexts.select(
        "anchor", "context", "n", F.col("at.k1").alias("k1"), F.shiftrightunsigned("at.place", 48).cast("int").alias("k2"),
        low.alias("low"), windows.alias("windows"),
    )
    crowds = contexts.where("anchor IS NOT NULL").groupBy("anchor").agg(F.count("*").alias("contexts"), F.min("n").alias("fewest"))
    crowds = crowds.where("contexts > 1 AND fewest = 1")
    total, size = contexts.agg(F.count("*"), F.sum(F.col("windows") + length)).first()
    buckets = int((size or 0) // BUCKET_BYTES) + 1
    crowded = _matched(contexts, ["anchor"], crowds, F.col("contexts") > total / width)
    wanted = written(crowded.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))).drop("fewest"))
    hot = F.col("contexts") > HOT_CONTEXTS

    def sort(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates(["anchor", "context", "s"])
        found = repeated(list(part["bytes"]), length)
        which = np.repeat(np.arange(len(part)), [len(x) for x in found])
        spans = np.array([x for xs in found for x in xs], dtype=np.int64).reshape(-1, 2) + part["s"].to_numpy()[which, None]
        return pd.DataFrame(
            {"anchor": part["anchor"].to_numpy()[which], "context": part["context"].to_numpy()[which], "s": spans[:, 0], "e": spans[:, 1]}
        )[part["n"].to_numpy()[which] == 1]

    sortable = _fetched(texts, wanted.where(~hot), length).withColumn("s", F.lit(0).cast("long"))
    flagged = contexts.where("n > 1").select("anchor", "context", F.lit(0).cast("long").alias("s"), F.col("windows").alias("e"))
    if not wanted.where(hot).isEmpty():
        more, equal = _narrowed(_fetched(texts, wanted.where(hot), length).drop("bucket"), length, buckets, width)
        for frame in more:
            sortable = sortable.unionByName(frame)
        for frame in equal:
            flagged = flagged.union(frame)
    flagged = flagged.union(sortable.groupBy("bucket").applyInPandas(sort, "anchor long, context long, s long, e long"))
    start = F.shiftright("place", 8).bitwiseAND((1 << 40) - 1)
    # A context that holds more than an even part of the rows is repeated as a whole.
    large = F.broadcast(contexts.where(F.col("n") > F.greatest(F.lit(1), F.lit(rows.count() / width))).select("anchor", "context"))
    whole = rows.join(large, ["anchor", "context"], "left_semi").select(
        "k1", "place", F.lit(0).cast("long").alias("s"), F.col("place").bitwiseAND(0xFF).alias("e")
    )
    other = rows.join(large, ["anchor", "context"], "left_anti").join(flagged, ["anchor", "context"]).select("k1", "place", "s", "e")
    spans = whole.union(other).select(
        "k1", F.shiftrightunsigned("place", 48).cast("int").alias("k2"),
        (start + F.col("s")).alias("s"), (start + F.col("e") + (length - 1)).alias("e"),
    )
    return spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def deduplicated(docs: DataFrame, kept: list[str], length: int = LENGTH, text: bool = True) -> DataFrame:
    """The columns `kept`, then _n_bytes, _spans (removed runs, in bytes), _kept_sha256 and, on demand, _kept bytes.

    Null texts are empty; texts shorter than `length` lose nothing; repeated rows lose
    all that is long enough, each alike; an empty table gives no rows. The kept bytes may
    end within a character, so they are binary.
    """
    fields = [f for f in docs.schema.fields if f.name in kept]
    spans = written(repeated_spans(docs, length))
    whole = F.coalesce(docs["text"].cast("string"), F.lit(""))
    source = docs.select(
        *(docs[f"`{f.name}`"].alias(f"c{k}") for k, f in enumerate(fields)), F.xxhash64("doc_id", whole).alias("k1"),
        F.pmod(F.hash("doc_id", whole), F.lit(1 << 16)).alias("k2"), whole.alias("_text"),
    ).join(spans, ["k1", "k2"], "left").select(*(f"c{k}" for k in range(len(fields))), "_text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])), pa.string()] + [pa.binary()] * text
        for batch in batches:
            out = []
            raw = batch.column(len(fields)).cast(pa.large_binary())
            for k, found in enumerate(batch.column(len(fields) + 1).to_pylist()):
                data = raw[k].as_py()
                merged = joined_spans([(x["s"], x["e"]) for x in found or ()])
                left = cut_bytes(data, merged)
                out.append((len(data), [{"s": s, "e": e} for s, e in merged], hashlib.sha256(left).hexdigest(), left))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(fields)], *(pa.array([x[c] for x in out], kind) for c, kind in enumerate(kinds))],
                names=[*(f.name for f in fields), "_n_bytes", "_spans", "_kept_sha256", "_kept"][: len(fields) + 3 + text],
            )

    schema = schema_of(fields, "_n_bytes long, _spans array<struct<s: long, e: long>>, _kept_sha256 string" + ", _kept binary" * text)
    return source.mapInArrow(run, schema)


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row."""
    removed = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    return deduplicated(docs, ["doc_id"], length, text=False).select(
        "doc_id",
        F.col("_n_bytes").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("_spans").cast("long").alias("n_spans"),
        F.col("_kept_sha256").alias("kept_sha256"),
    )
