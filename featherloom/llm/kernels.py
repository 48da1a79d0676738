"""Array kernels over the bytes of many texts at once; used inside tasks.

A chunk is the concatenation of whole texts. Hashes of byte or word ranges come from one
polynomial prefix sum modulo 2^64, so any range costs two lookups and a multiplication.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one chunk holds; a longer text is a chunk of its own.
CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: Low bits of a packed gram that hold its place in the chunk.
PLACE_BITS = 30


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def byte_codes() -> np.ndarray:
    """A random-looking 64-bit code for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Prefix hashes; keeps its tables of powers between chunks."""

    def __init__(self) -> None:
        self.codes = byte_codes()
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) <= n:
            self.up, self.down = _powers(BASE, 2 * n), _powers(_BASE_INVERSE, 2 * n)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums of the items' 64-bit codes times powers of the base."""
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.up[:len(values)], out=out[1:], dtype=np.uint64)
        return out

    def ranges(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of the items start..end of each range."""
        return mix((prefix[end] - prefix[start]) * self.down[start])

    def grams(self, prefix: np.ndarray, k: int) -> np.ndarray:
        """Hashes of all k consecutive items."""
        n = len(prefix) - 1 - k + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mix((prefix[k:] - prefix[:n]) * self.down[:n])


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for a, b in ranges:
        out[a:b + 1] = True
    return out


#: Bytes between words: space and tab to carriage return.
SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
#: Bytes between words of letters and digits: ASCII that is neither, after lower-casing.
NOT_WORD = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_chunks(texts: pa.Array, limit: int = CHUNK
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None and \
        buffers[2].size else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield (first, end, data[offsets[first]:offsets[end]],
               offsets[first:end + 1] - offsets[first])
        first = end


def word_bounds(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the first word of each text (one more at the end)."""
    inside = ~gap[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    after[edges - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def owners(first: np.ndarray) -> np.ndarray:
    """Text of each item, from the first item of each text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def whole_windows(first: np.ndarray, width: int, n: int) -> np.ndarray:
    """True where a window of ``width`` items starts and ends in the same text."""
    counts = np.diff(first)
    out = np.repeat(first[1:] - width, counts) >= np.arange(n)
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    if span < width:
        values = np.minimum(values[:span - width], values[width - span:])
    return values


def anchored_segments(hasher: Hasher, prefix: np.ndarray, first: np.ndarray, width: int, k: int
                      ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Splits all windows of ``width`` items into runs that share their least k-gram.

    Equal windows have the same least gram at the same distance, wherever they occur.
    Returns per run: first window, last window, place of the gram, hash of the gram.
    """
    n = len(prefix) - 1
    none = np.zeros(0, dtype=np.int64)
    if n < width:
        return none, none, none, none.astype(np.uint64)
    grams = hasher.grams(prefix, k)
    low = np.uint64((1 << PLACE_BITS) - 1)
    packed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    least = (sliding_min(packed, width - k + 1) & low).astype(np.int64)
    valid = np.flatnonzero(whole_windows(first, width, n)[:len(least)])
    if not len(valid):
        return none, none, none, none.astype(np.uint64)
    place = least[valid]
    new = np.ones(len(valid), dtype=bool)
    new[1:] = (np.diff(valid) > 1) | (np.diff(place) != 0)
    # windows of two texts that follow each other without a gap in ``valid`` differ in place
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(valid)) - 1
    return valid[begin], valid[last], place[begin], grams[place[begin]]


def covered_mask(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """True for items inside any of the ranges."""
    delta = np.zeros(n + 1, dtype=np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, ends, -1)
    return np.cumsum(delta[:-1]) > 0


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges as disjoint maximal ranges; touching ranges join."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), dtype=bool)
    new[1:] = starts[1:] > reach[:-1]
    begin = np.flatnonzero(new)
    return starts[begin], reach[np.append(begin[1:], len(starts)) - 1]
