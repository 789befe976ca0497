"""Words of many texts at once, as 64-bit hashes, from an Arrow text column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 1 << 20  # texts handled at a time; one longer text is a slice of its own
LONG_WORD = 32  # longer words are hashed one by one

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """A table that is true for the bytes in the spans, ends included."""
    table = np.zeros(256, dtype=bool)
    for low, high in spans:
        table[low : high + 1] = True
    return table


#: ASCII letters and digits, and every byte of a longer UTF-8 character.
ALNUM = byte_class((48, 57), (65, 90), (97, 122), (128, 255))
#: All but ASCII white space.
SOLID = ~byte_class((9, 13), (32, 32))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits; one to one."""
    h = (h ^ (h >> np.uint64(32))) * _M2
    h = (h ^ (h >> np.uint64(32))) * _M2
    return h ^ (h >> np.uint64(32))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of whole texts of about `limit` bytes. Null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the number of its first word."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = member[data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[inner] = inside[1:-1][inner]
    ends[inner - 1] = inside[1:-1][inner - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def hashed_words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, A-Z lower-cased, and for each text the number of its first word."""
    data = LOWER[data]
    starts, stops, firsts = word_spans(data, offsets, member)
    lengths = stops - starts
    hashes = lengths.astype(np.uint64) * _M1
    padded = np.concatenate([data, np.zeros(LONG_WORD + 8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), shape=(len(padded) - 7,), strides=(1,))
    masks = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
    which = np.arange(len(starts))
    for at in range(0, LONG_WORD, 8):
        which = which[(lengths[which] > at) & (lengths[which] <= LONG_WORD)] if at == 0 else which[lengths[which] > at]
        if not len(which):
            break
        part = eight[starts[which] + at] & masks[np.minimum(lengths[which] - at, 8)]
        hashes[which] = mix(hashes[which] ^ part) * _M1
    for i in np.flatnonzero(lengths > LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : stops[i]])
    return hashes, firsts


def chained(*parts: np.ndarray) -> np.ndarray:
    """One hash for each sequence of hashes; the order counts."""
    h = np.full(len(parts[0]), len(parts), dtype=np.uint64)
    for part in parts:
        h = mix(h * _M1 ^ part)
    return h
