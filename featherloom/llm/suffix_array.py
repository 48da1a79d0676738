"""Substring deduplication over bytes with induced suffix sorting.

Each shard lays its segments end to end, a separator after each, and sorts the suffixes by
induction: suffixes are classified, the substrings between leftmost smaller suffixes are sorted by
one induction and named, the string of names is sorted, and a second induction from the sorted
leftmost smaller suffixes gives the array. The bucket of each byte moves as one array, so a shard
costs a fixed number of passes. Permuted common prefixes then join equal windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from featherloom.llm.common import fresh
from featherloom.llm.repeats import Unit, repeated_ranges
from featherloom.naming import quoted

#: Bytes of a gram that anchors a window.
GRAM = 12


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last suffix counts as smaller."""
    n = len(text)
    smaller = np.zeros(n, dtype=bool)
    smaller[:-1] = text[:-1] < text[1:]
    smaller[-1] = True
    differs = np.append(text[:-1] != text[1:], True)
    where = np.where(differs, np.arange(n), n - 1)
    following = np.minimum.accumulate(where[::-1])[::-1]
    return smaller[following]


def _induce(text: np.ndarray, smaller: np.ndarray, left: np.ndarray, edges: np.ndarray
            ) -> np.ndarray:
    """Suffix array induced from the leftmost smaller suffixes in the given order."""
    n, letters = len(text), len(edges) - 1
    out = np.full(n, -1, dtype=np.int64)
    by_letter = text[left]
    seeds = [None] * letters
    begin = np.searchsorted(by_letter, np.arange(letters + 1))
    head = edges[:-1].copy()
    for c in range(letters):
        seeds[c] = left[begin[c]:begin[c + 1]]

    def push(block: np.ndarray, c: int, larger: bool) -> None:
        """Puts the preceding suffixes of one type into their buckets, in scan order."""
        before = block - 1
        before = before[before >= 0]
        before = before[smaller[before] != larger]
        letter = text[before]
        order = np.argsort(letter, kind="stable")
        before, letter = before[order], letter[order]
        counts = np.bincount(letter, minlength=letters)
        rank = np.arange(len(letter)) - np.repeat(np.cumsum(counts) - counts, counts)
        if larger:
            out[head[letter] + rank] = before
            np.add(head, counts, out=head)
        else:
            out[tail[letter] - 1 - rank] = before
            np.subtract(tail, counts, out=tail)

    for c in range(letters):
        done = edges[c]
        while head[c] > done:
            block, done = out[done:head[c]], head[c]
            push(block, c, True)
        if len(seeds[c]):
            push(seeds[c], c, True)
    tail = edges[1:].copy()
    for c in range(letters - 1, -1, -1):
        done = edges[c + 1]
        while tail[c] < done:
            block, done = out[tail[c]:done][::-1], tail[c]
            push(block, c, False)
        larger = out[edges[c]:head[c]]
        if len(larger):
            push(larger[::-1], c, False)
    out[0] = n - 1  # the last suffix has no successor that could induce it
    return out


def _rank_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names: pairs of neighbours are renamed until all
    names differ, so each level compares twice as much."""
    span, n = 1, len(names)
    names = names.astype(np.int64)
    while True:
        following = np.full(n, -1, dtype=np.int64)
        following[:-span] = names[span:]
        key = names * (n + 2) + (following + 1)
        order = np.argsort(key)
        ranked = key[order]
        fresh_name = np.ones(n, dtype=bool)
        fresh_name[1:] = ranked[1:] != ranked[:-1]
        names = np.empty(n, dtype=np.int64)
        names[order] = np.cumsum(fresh_name) - 1
        span *= 2
        if fresh_name.all() or span >= n:
            return order


def suffix_array(text: np.ndarray, letters: int) -> np.ndarray:
    """Suffix array of an integer string whose last letter is its only 0."""
    n = len(text)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    smaller = suffix_types(text)
    left = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    edges = np.append(0, np.cumsum(np.bincount(text, minlength=letters)))
    rough = _induce(text, smaller, left[np.argsort(text[left], kind="stable")], edges)
    is_left = np.zeros(n, dtype=bool)
    is_left[left] = True
    order = rough[is_left[rough]]
    names = np.empty(n, dtype=np.int64)
    names[order] = np.cumsum(_differs(text, order, left, is_left))
    names = names[left]
    return _induce(text, smaller, left[_rank_names(names)], edges)


def _differs(text: np.ndarray, order: np.ndarray, left: np.ndarray, is_left: np.ndarray
             ) -> np.ndarray:
    """True where a leftmost-smaller substring differs from the one sorted before it."""
    n = len(text)
    length = np.zeros(n, dtype=np.int64)
    length[left] = np.append(np.diff(left), n - 1 - left[-1])
    out = length[order] != np.roll(length[order], 1)
    out[0] = False
    alive = np.flatnonzero(~out)
    alive = alive[alive > 0]
    a, b, rest = order[alive], order[alive - 1], length[order[alive]]
    step = 0
    while len(alive):
        unequal = text[np.minimum(a + step, n - 1)] != text[np.minimum(b + step, n - 1)]
        out[alive[unequal]] = True
        keep = ~unequal & (rest > step)
        alive, a, b, rest = alive[keep], a[keep], b[keep], rest[keep]
        step += 1
    return out


def common_prefixes(data: np.ndarray, previous: np.ndarray, limit: int) -> np.ndarray:
    """Permuted common prefixes, in text order and no longer than ``limit``: how far the suffix
    at each place agrees with the one sorted before it (``previous``, -1 for none)."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray(shape=(n,), dtype="<u8", buffer=padded, strides=(1,))
    out = np.zeros(n, dtype=np.int64)
    alive = np.flatnonzero(previous >= 0)
    at = 0
    while len(alive) and at < limit:
        a, b = alive + at, previous[alive] + at
        inside = (a < n) & (b < n)
        alive, a, b = alive[inside], a[inside], b[inside]
        differs = eight[a] ^ eight[b]
        stop = differs != 0
        low = differs[stop] & (~differs[stop] + np.uint64(1))
        out[alive[stop]] = at + (np.log2(low.astype(np.float64)) // 8).astype(np.int64)
        alive = alive[~stop]
        at += 8
        out[alive] = at
    return np.minimum(out, limit)


def repeated_windows(items: np.ndarray, lengths: np.ndarray, width: int
                     ) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows of ``width`` bytes that occur more than once, with group labels."""
    count, n = len(lengths), len(items)
    ends = np.cumsum(lengths)
    spots = np.arange(n) + np.repeat(np.arange(count), lengths)
    text = np.ones(n + count + 1, dtype=np.int16)
    text[spots] = items.astype(np.int16) + 2
    text[-1] = 0
    array = suffix_array(text, 258)[1:]
    data = np.zeros(n + count, dtype=np.uint8)
    data[spots] = items
    rest = np.zeros(n + count, dtype=np.int64)
    rest[spots] = np.repeat(ends, lengths) - np.arange(n)
    previous = np.full(n + count, -1, dtype=np.int64)
    previous[array[1:]] = array[:-1]
    prefix = np.minimum(common_prefixes(data, previous, width), rest)
    prefix = np.where(previous >= 0, np.minimum(prefix, rest[previous]), 0)
    same = prefix[array] >= width
    member = same | np.append(same[1:], False)
    label = np.cumsum(~same)[member]
    where = array[member]
    owner = np.searchsorted(ends + np.arange(1, count + 1), where, side="right")
    return where - owner, label


def _without_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(0).cast(pa.large_binary()).to_pylist()
        starts, ends = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        kept, removed = [], []
        for text, a, b in zip(texts, starts, ends, strict=True):
            text = text or b""
            if not a:
                kept.append(text)
                removed.append(0)
                continue
            pieces, at = [], 0
            for x, y in zip(a, b, strict=True):
                pieces.append(text[at:x])
                at = y
            pieces.append(text[at:])
            kept.append(b"".join(pieces))
            removed.append(sum(b) - sum(a))
        spans = [len(a or ()) for a in starts]
        n_bytes = [len(t or b"") for t in texts]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[3:], pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
            names=[*batch.schema.names[3:], "n_bytes", "n_removed", "n_spans", "kept"])


def dedup_substrings(df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                     width: int = 100, keep: tuple[str, ...] = ()) -> DataFrame:
    """Removes every byte covered by a ``width``-byte string that also starts earlier.

    Earlier is a smaller id, or the same id and an earlier start; strings are judged on the input
    and never cross texts. Returns the id, the columns of ``keep``, n_bytes, n_removed, n_spans
    (maximal removed runs) and kept (binary, as a cut may split a character).

    Null text counts as empty: nothing is removed and nothing kept. Texts shorter than ``width``
    stay whole. A null id comes after every other id. Rows that share an id count as one document
    whose texts all start at 0, so of two such rows neither removes what starts at the same place
    in the other; repeated rows get equal results. An empty table gives an empty table. Memory of a
    task: one chunk or the longest text times about 80, plus one shard.
    """
    unit = Unit(words=False, width=width, gram=GRAM, inside=True)
    ranged = repeated_ranges(df.select(*[quoted(c) for c in (id_column, *keep, text_column)]),
                             id_column, text_column, unit, repeated_windows)
    starts, ends = ranged.columns[-2:]
    text = fresh(ranged, "whole_text")[0]
    types = {f.name: f.dataType for f in df.schema}
    schema = T.StructType([T.StructField(c, types[c]) for c in (id_column, *keep)]
                          + [T.StructField(c, T.LongType())
                             for c in ("n_bytes", "n_removed", "n_spans")]
                          + [T.StructField("kept", T.BinaryType())])
    return (ranged.select(quoted(text_column).alias(text), quoted(starts), quoted(ends),
                          quoted(id_column), *[quoted(c) for c in keep])
            .mapInArrow(_without_bytes, schema))


def dedup_digest(df: DataFrame) -> DataFrame:
    """One row per document: sizes of what was removed and a digest of what is left."""
    out = dedup_substrings(df)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans",
                      F.sha2("kept", 256).alias("kept_sha256"))
