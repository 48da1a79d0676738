"""Benchmark decontamination with a broadcast hash set of normalised n-grams.

Test items become windows of words; their hashes go to every task. Tasks scan the token windows of
all texts at once, look the hashes up, and verify hits word by word. The items are broadcast in
parts of bounded size, one after the other over the same rows, so nothing is shuffled.

The size of all items is summed first. Above ``BROADCAST_BYTES`` only a sieve of fixed size is
broadcast, and the windows that pass it meet those of the items in a join on the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from featherloom.llm.common import fresh, materialise
from featherloom.llm.kernels import (LOWER, NOT_WORD, Hasher, merged, text_chunks, whole_windows,
                                     word_bounds)
from featherloom.naming import quoted

#: Words of a window.
WINDOW = 10
#: Most bytes of item text in one broadcast part; windows take some ten times as much.
PART_BYTES = 4 << 20
#: Most bytes of item text that are broadcast in all.
BROADCAST_BYTES = 64 << 20
#: Bits of a cell number in the sieve of a benchmark that is joined.
CELL_BITS = 24
#: Entries of the table that most other windows fail at once.
SIEVE_BITS = 20


def item_windows(text: str | None, hasher: Hasher, window: int
                 ) -> tuple[int, np.ndarray, list[bytes]]:
    """(words of a window, hash of each, words of each) of an item; without words, none."""
    data = LOWER[np.frombuffer((text or "").encode(), dtype=np.uint8)]
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]), NOT_WORD)
    length = min(window, len(starts))
    if not length:
        return 0, np.zeros(0, dtype=np.uint64), []
    hashes = hasher.ranges(hasher.prefix(hasher.codes[data]), starts, ends)
    grams = hasher.grams(hasher.prefix(hashes), length)
    raw = data.tobytes()
    words = [raw[a:b] for a, b in zip(starts, ends, strict=True)]
    return length, grams, [b" ".join(words[i:i + length]) for i in range(len(grams))]


class Windows:
    """Windows of one part of the items: sorted hashes, their words, and the items of each."""

    def __init__(self, items: list[tuple[int | None, str]], window: int) -> None:
        hasher = Hasher()
        self.words: dict[int, set[bytes]] = {}
        self.items: dict[bytes, set[int | None]] = {}
        by_length: dict[int, set[int]] = {}
        for item, text in items:
            length, grams, phrases = item_windows(text, hasher, window)
            for gram, phrase in zip(grams.tolist(), phrases, strict=True):
                self.words.setdefault(gram, set()).add(phrase)
                self.items.setdefault(phrase, set()).add(item)
                by_length.setdefault(length, set()).add(gram)
        self.hashes = {n: np.sort(np.array(list(g), dtype=np.uint64))
                       for n, g in by_length.items()}
        self.sieves = {}
        for n, g in self.hashes.items():
            sieve = np.zeros(1 << SIEVE_BITS, dtype=bool)
            sieve[g >> np.uint64(64 - SIEVE_BITS)] = True
            self.sieves[n] = sieve

    def find(self, grams: np.ndarray, length: int) -> np.ndarray:
        """Places of the grams that are in the set."""
        near = np.flatnonzero(self.sieves[length][grams >> np.uint64(64 - SIEVE_BITS)])
        known = self.hashes[length]
        at = np.minimum(np.searchsorted(known, grams[near]), len(known) - 1)
        return near[known[at] == grams[near]]


def _scan(part: Broadcast, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, hasher = Windows(part.value, window), Hasher()
        for batch in batches:
            names = batch.schema.names
            n_words = np.zeros(len(batch), dtype=np.int64)
            starts_of = batch.column(1).to_pylist()
            ends_of, items_of = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for a, _, data, offsets in text_chunks(batch.column(0)):
                data = LOWER[data]
                starts, ends, first = word_bounds(data, offsets, NOT_WORD)
                n_words[a:a + len(first) - 1] = np.diff(first)
                hashes = hasher.ranges(hasher.prefix(hasher.codes[data]), starts, ends)
                prefix = hasher.prefix(hashes)
                found = {}
                for length in windows.hashes:
                    grams = hasher.grams(prefix, length)
                    places = windows.find(grams, length)
                    places = places[whole_windows(first, length, len(starts))[places]]
                    for i in places.tolist():
                        phrase = b" ".join(data[x:y].tobytes() for x, y in zip(
                            starts[i:i + length], ends[i:i + length], strict=True))
                        if phrase in windows.words[int(grams[i])]:
                            row = int(np.searchsorted(first, i, side="right")) - 1
                            spans, items = found.setdefault(row, ([], set()))
                            spans.append((i - int(first[row]), i - int(first[row]) + length))
                            items |= windows.items[phrase]
                for row, (spans, items) in found.items():
                    r = a + row
                    old = list(zip(starts_of[r] or (), ends_of[r] or (), strict=True))
                    pair = np.array(old + spans, dtype=np.int64)
                    begin, end = merged(pair[:, 0], pair[:, 1])
                    starts_of[r], ends_of[r] = begin.tolist(), end.tolist()
                    items_of[r] = sorted({*(items_of[r] or ()), *(i for i in items
                                                                  if i is not None)})
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(starts_of, longs), pa.array(ends_of, longs),
                 pa.array(items_of, longs), pa.array(n_words), *batch.columns[5:]], names=names)
    return run


def _parts(benchmark: DataFrame, item_column: str, text_column: str) -> Iterator[list]:
    """The items in parts of bounded size, read through one by one."""
    items = benchmark.select(quoted(item_column).cast("long"), quoted(text_column)).where(
        quoted(text_column).isNotNull()).distinct()
    part, size = [], 0
    for item, text in items.toLocalIterator():
        part.append((item, text))
        size += len(text)
        if size >= PART_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def _item_rows(window: int):
    """Rows (hash, length, phrase, item) of the windows of items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                length, grams, phrases = item_windows(text, hasher, window)
                n = len(grams)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams.view(np.int64)), pa.array([length] * n, pa.int32()),
                     pa.array(phrases, pa.binary()), pa.array([item] * n, pa.int64())],
                    names=["hash", "length", "phrase", "item"])
    return run


def _candidates(sieve: Broadcast, lengths: list[int]):
    """Rows (k1, k2, start, length, hash, phrase) of the windows of texts that pass the sieve."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            keys = [c.to_numpy() for c in batch.columns[1:]]
            for a, _, data, offsets in text_chunks(batch.column(0)):
                data = LOWER[data]
                starts, ends, first = word_bounds(data, offsets, NOT_WORD)
                hashes = hasher.ranges(hasher.prefix(hasher.codes[data]), starts, ends)
                prefix = hasher.prefix(hashes)
                for length in lengths:
                    grams = hasher.grams(prefix, length)
                    at = np.flatnonzero(sieve.value[grams >> np.uint64(64 - CELL_BITS)])
                    at = at[whole_windows(first, length, len(starts))[at]]
                    row = np.searchsorted(first, at, side="right") - 1
                    phrases = [b" ".join(data[x:y].tobytes() for x, y in zip(
                        starts[i:i + length], ends[i:i + length], strict=True)) for i in at]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(k[a + row]) for k in keys), pa.array(at - first[row]),
                         pa.array(np.full(len(at), length, dtype=np.int32)),
                         pa.array(grams[at].view(np.int64)), pa.array(phrases, pa.binary())],
                        names=["k1", "k2", "start", "length", "hash", "phrase"])
    return run


def _merge_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ranges = [merged(*np.array([(h["start"], h["end"]) for h in hits], dtype=np.int64).T)
                  for hits in batch.column(2).to_pylist()]
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array([a.tolist() for a, _ in ranges], longs),
             pa.array([b.tolist() for _, b in ranges], longs), batch.column(3)],
            names=["k1", "k2", "starts", "ends", "items"])


def _found_by_join(texts: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """(k1, k2, starts, ends, items) of the texts that hold a window, by a join on its words.

    The driver gets the sieve, 2^24 bits, and at most ``window`` lengths. Windows of items are
    written once; of texts only those move that pass the sieve.
    """
    spark = texts.sparkSession
    rows = materialise(items.mapInArrow(
        _item_rows(window), "hash long, length int, phrase binary, item long").distinct())
    cell = F.shiftrightunsigned("hash", 64 - CELL_BITS)
    bits = rows.groupBy((cell / 64).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (cell % 64).cast("int")))
        .alias("bits")).toPandas()
    sieve = np.zeros(1 << (CELL_BITS - 6), dtype=np.int64)
    sieve[bits["word"].to_numpy()] = bits["bits"].to_numpy()
    sieve = np.unpackbits(sieve.view(np.uint8), bitorder="little").astype(bool)
    lengths = sorted(r["length"] for r in rows.select("length").distinct().collect())
    key = ["hash", "length", "phrase"]
    passed = materialise(texts.mapInArrow(
        _candidates(spark.sparkContext.broadcast(sieve), lengths),
        "k1 long, k2 long, start long, length int, hash long, phrase binary"))
    hits = (passed.join(rows.select(*key).distinct().hint("merge"), key)
            .groupBy("k1", "k2").agg(F.collect_set(F.struct(
                "start", (F.col("start") + F.col("length")).alias("end"))).alias("hits")))
    named = (passed.select("k1", "k2", *key).distinct()
             .join(rows.where("item IS NOT NULL").hint("merge"), key)
             .groupBy("k1", "k2").agg(F.array_sort(F.collect_set("item")).alias("items")))
    return hits.join(named, ["k1", "k2"], "left").select("k1", "k2", "hits", "items").mapInArrow(
        _merge_hits, "k1 long, k2 long, starts array<long>, ends array<long>, items array<long>")


def mark(df: DataFrame, benchmark: DataFrame, text_column: str = "text",
         item_column: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Adds to each row n_words, hits (array of (start, end) word ranges that a window of an item
    covers), n_hit (their words), items (sorted ids of the items found) and contaminated.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. A window is
    ``window`` consecutive words of an item, or the whole of a shorter item. Null and empty texts
    have no words and no hits, and items without words match nothing. Items with a null id mark
    words but are not listed; repeated items count once. Input columns with names of added ones
    are replaced. Empty tables give an empty or an unmarked table. Texts of a benchmark above
    ``BROADCAST_BYTES`` (64 MB) are joined rather than broadcast; the rows are the same.
    """
    added = ("n_words", "hits", "n_hit", "items", "contaminated")
    df = df.select(*[quoted(c) for c in df.columns if c.lower() not in added])
    text, starts, ends, items, n_words = fresh(df, "t_text", "t_starts", "t_ends", "t_items",
                                               "t_words")
    longs = T.ArrayType(T.LongType())
    none = F.lit(None).cast(longs)
    work = df.select(quoted(text_column).alias(text), none.alias(starts), none.alias(ends),
                     none.alias(items), F.lit(0).cast("long").alias(n_words),
                     *[quoted(c) for c in df.columns if c != text_column])
    context = df.sparkSession.sparkContext
    size = benchmark.agg(F.sum(F.octet_length(quoted(item_text)))).first()[0] or 0
    small = size <= BROADCAST_BYTES
    scans = 0
    for part in _parts(benchmark, item_column, item_text) if small else ():
        work = work.mapInArrow(_scan(context.broadcast(part), window), work.schema)
        scans += 1
    if not scans:  # a part without windows still counts the words
        work = work.mapInArrow(_scan(context.broadcast([]), window), work.schema)
    if not small:
        keys = fresh(work, "t_k1", "t_k2")
        hashes = [F.xxhash64(F.lit(i), quoted(text)) for i in (0, 1)]
        found = _found_by_join(
            work.select(text, *[h.alias(k) for h, k in zip(hashes, ("k1", "k2"), strict=True)]),
            benchmark.select(quoted(item_column).cast("long"), quoted(item_text)), window)
        found = found.toDF(*keys, starts, ends, items)
        work = work.drop(starts, ends, items).withColumns(
            dict(zip(keys, hashes, strict=True))).join(found, keys, "left")
    hits = F.when(quoted(starts).isNotNull(), F.arrays_zip(
        quoted(starts).alias("start"), quoted(ends).alias("end"))).otherwise(
        F.array().cast("array<struct<start:bigint,end:bigint>>"))
    out = work.select(
        *[quoted(text).alias(c) if c == text_column else quoted(c) for c in df.columns],
        quoted(n_words).alias("n_words"), hits.alias("hits"),
        F.coalesce(quoted(items), F.array().cast(longs)).alias("items"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["end"] - h["start"])
    return out.withColumn("n_hit", n_hit).withColumn("contaminated", F.col("n_hit") > 0)


def decontaminate(df: DataFrame, benchmark: DataFrame, text_column: str = "text",
                  item_column: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  ) -> DataFrame:
    """The rows without those that hold a window of an item, with all columns; see ``mark``."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    marked = mark(df.select(*[quoted(c).alias(n) for c, n in names.items()]), benchmark,
                  names[text_column], item_column, item_text, window)
    return marked.where(~F.col("contaminated")).select(
        *[F.col(n).alias(c) for c, n in names.items()])


def contamination_digest(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, hit words, items found and a digest of their ids."""
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return mark(df.select("doc_id", "text"), benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), "contaminated")
