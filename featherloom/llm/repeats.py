"""Finds items that repeat in long windows, over all texts: the plan shared by both deduplicators.

An item is a byte or a word. Every window of ``width`` items is assigned to its least k-gram,
the anchor, so equal windows meet at equal anchors. Runs of windows with one anchor are
segments. The plan:

1. scan: cut all texts into segments; a segment whose equal was seen in the same task is settled
   there, the rest go to shards of the anchor's hash as packed arrays;
2. resolve: per shard, settle equal segments; of segments with one anchor but different content,
   keep those that agree on the half window left or right of it, as nothing else can share a window;
3. cut: fetch the items of the kept half segments and send them to shards of (anchor, half window);
4. sort: a suffix array or suffix tree over each shard finds the windows that repeat;
5. merge the ranges of each text.

Segments compare by 64 bits of hash of the anchor and 64 of the whole segment, windows item by item
(words by 64 bits of hash). Ordering is (doc_id, start) or doc_id alone; a null doc_id comes after
all others. Rows that share a doc_id are told apart by 64 bits of hash of the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from featherloom.llm.common import fresh, materialise, partitions
from featherloom.llm.kernels import (SPACE, Hasher, anchored_segments, merged, mix, owners,
                                     text_chunks, word_bounds)
from featherloom.naming import quoted

#: Order of a null id.
LAST_ID = (1 << 63) - 1
#: Segments that a scan task holds before it sends them on.
FLUSH = 1_500_000

SEGMENT = {"anchor": "u8", "digest": "u8", "doc": "i8", "tag": "i8", "start": "u4",
           "left": "u4", "right": "u4", "before": "u1", "windows": "u1"}
RANGE = {"doc": "i8", "tag": "i8", "start": "u4", "length": "u4"}
REQUEST = {**RANGE, "key": "u8"}
PACKED = "shard int, kind int, packed binary"
Columns = dict[str, np.ndarray]


@dataclass(frozen=True)
class Unit:
    """What repeats: items of ``width`` bytes or words, anchored by ``gram`` of them.

    ``inside`` counts an earlier start in the same document too.
    """

    words: bool
    width: int
    gram: int
    inside: bool

    @property
    def half(self) -> int:
        return (self.width - self.gram) // 2


def pack(columns: Columns) -> bytes:
    return b"".join(np.ascontiguousarray(c).tobytes() for c in columns.values())


def row_bytes(layout: dict[str, str]) -> int:
    return sum(np.dtype(t).itemsize for t in layout.values())


def unpack(layout: dict[str, str], blobs: list[bytes]) -> Columns:
    size = row_bytes(layout)
    parts: dict[str, list[np.ndarray]] = {name: [] for name in layout}
    for blob in blobs:
        n, at = len(blob) // size, 0
        for name, kind in layout.items():
            parts[name].append(np.frombuffer(blob, dtype=kind, count=n, offset=at))
            at += n * np.dtype(kind).itemsize
    return {name: np.concatenate(p) if p else np.zeros(0, dtype=layout[name])
            for name, p in parts.items()}


def take(columns: Columns, index: np.ndarray) -> Columns:
    return {name: c[index] for name, c in columns.items()}


def joined(parts: list[Columns]) -> Columns:
    return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}


def by_shard(columns: Columns, shard: np.ndarray) -> Iterator[tuple[int, Columns]]:
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    edges = np.flatnonzero(np.diff(shard)) + 1
    for a, b in zip(np.append(0, edges), np.append(edges, len(shard)), strict=True):
        if b > a:
            yield int(shard[a]), take(columns, order[a:b])


def doc_shard(columns: Columns, shards: int) -> np.ndarray:
    mixed = mix(columns["doc"].astype(np.uint64) ^ (columns["tag"].astype(np.uint64)
                                                     << np.uint64(17)))
    return (mixed % np.uint64(shards)).astype(np.int32)


def packed_rows(shard_kind: list[tuple[int, int, bytes]], schema: pa.Schema) -> pa.RecordBatch:
    shards, kinds, blobs = zip(*shard_kind, strict=True) if shard_kind else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(kinds, pa.int32()),
                                       pa.array(blobs, pa.binary())], schema=schema)


def packed_schema() -> pa.Schema:
    return pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("packed", pa.binary())])


def after_first(group: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """True for entries whose (doc, start) is above the least of their group."""
    out = np.zeros(len(group), dtype=bool)
    if not len(group):
        return out
    order = np.argsort(group, kind="stable")
    sorted_group = group[order]
    same = sorted_group[1:] == sorted_group[:-1]
    several = order[np.append(same, False) | np.append(False, same)]
    if not len(several):
        return out
    several = several[np.lexsort((start[several], doc[several], group[several]))]
    g, d, s = group[several], doc[several], start[several]
    new = np.ones(len(several), dtype=bool)
    new[1:] = g[1:] != g[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(several)), 0))
    out[several] = (d != d[head]) | (s != s[head])
    return out


def numbered(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number for each pair of values, equal where both are."""
    order = np.lexsort((b, a))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def _settle(seg: Columns, unit: Unit) -> tuple[Columns, Columns]:
    """(open segments, ranges covered by an equal segment that comes earlier)."""
    group = numbered(seg["anchor"], seg["digest"])
    start = seg["start"] if unit.inside else np.zeros(len(group), dtype=np.uint32)
    late = after_first(group, seg["doc"], start)
    gone = take(seg, np.flatnonzero(late))
    covered = {"doc": gone["doc"], "tag": gone["tag"], "start": gone["start"],
               "length": gone["windows"].astype(np.uint32) + np.uint32(unit.width - 1)}
    return take(seg, np.flatnonzero(~late)), covered


def _segments(hasher: Hasher, texts: pa.Array, doc: np.ndarray, tag: np.ndarray, unit: Unit
              ) -> Iterator[Columns]:
    for a, _, data, offsets in text_chunks(texts):
        prefix, first = hasher.prefix(hasher.codes[data]), offsets
        if unit.words:
            starts, ends, first = word_bounds(data, offsets, SPACE)
            prefix = hasher.prefix(hasher.ranges(prefix, starts, ends))
        s0, s1, place, anchor = anchored_segments(hasher, prefix, first, unit.width, unit.gram)
        if not len(s0):
            continue
        before = place - s0
        digest = mix(hasher.ranges(prefix, s0, s1 + unit.width) ^ before.astype(np.uint64))
        left = hasher.ranges(prefix, np.maximum(place - unit.half, s0), place + unit.gram)
        right = hasher.ranges(prefix, place,
                              np.minimum(place + unit.width - unit.half, s1 + unit.width))
        owner = np.searchsorted(first, s0, side="right") - 1
        yield {"anchor": anchor, "digest": digest, "doc": doc[a + owner], "tag": tag[a + owner],
               "start": (s0 - first[owner]).astype(np.uint32), "left": left.astype(np.uint32),
               "right": right.astype(np.uint32), "before": before.astype(np.uint8),
               "windows": (s1 - s0 + 1).astype(np.uint8)}


def _scan(unit: Unit, shards: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, hasher, held, count = packed_schema(), Hasher(), [], 0

        def flush() -> pa.RecordBatch:
            rows, covered = [], None
            left, covered = _settle(joined(held), unit)
            for shard, part in by_shard(left, (left["anchor"] % np.uint64(shards)).astype(int)):
                rows.append((shard, 1, pack(part)))
            for shard, part in by_shard(covered, doc_shard(covered, shards)):
                rows.append((shard, 0, pack(part)))
            return packed_rows(rows, schema)

        for batch in batches:
            doc = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            tag = batch.column(1).to_numpy(zero_copy_only=False)
            for part in _segments(hasher, batch.column(2), doc, tag, unit):
                held.append(part)
                count += len(part["doc"])
                if count >= FLUSH:
                    yield flush()
                    held, count = [], 0
        if held:
            yield flush()
    return run


def _agreeing(group: np.ndarray, digest: np.ndarray, where: np.ndarray) -> np.ndarray:
    """True for entries of ``where`` whose group holds another digest too."""
    out = np.zeros(len(group), dtype=bool)
    index = np.flatnonzero(where)
    index = index[np.lexsort((digest[index], group[index]))]
    g, d = group[index], digest[index]
    if not len(g):
        return out
    new = np.ones(len(g), dtype=bool)
    new[1:] = g[1:] != g[:-1]
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(g)) - 1
    several = d[begin] != d[last]
    out[index] = np.repeat(several, last - begin + 1)
    return out


def _requests(seg: Columns, unit: Unit) -> Columns:
    """The half segments that may share a window with a different segment."""
    before, windows = seg["before"].astype(np.int64), seg["windows"].astype(np.int64)
    start = seg["start"].astype(np.int64)
    on_left = np.clip(before - unit.half + 1, 0, windows)  # windows that reach far to the left
    parts = []
    for side, where, a, n in (("left", on_left > 0, start, on_left),
                              ("right", on_left < windows, start + on_left, windows - on_left)):
        key = mix(seg["anchor"] ^ mix(seg[side].astype(np.uint64)
                                      + np.uint64(1 + (side == "left"))))
        hit = np.flatnonzero(_agreeing(key, seg["digest"], where))
        parts.append({"doc": seg["doc"][hit], "tag": seg["tag"][hit],
                      "start": a[hit].astype(np.uint32),
                      "length": (n[hit] + unit.width - 1).astype(np.uint32), "key": key[hit]})
    return joined(parts)


def _resolve(unit: Unit, shards: int) -> Callable:
    def run(group: pa.Table) -> pa.Table:
        kinds = group.column("kind").to_numpy()
        blobs = group.column("packed").to_pylist()
        rows = [(group.column("shard")[0].as_py(), 0, b)
                for b, k in zip(blobs, kinds, strict=True) if k == 0]
        seg = unpack(SEGMENT, [b for b, k in zip(blobs, kinds, strict=True) if k == 1])
        left, covered = _settle(seg, unit)
        for shard, part in by_shard(covered, doc_shard(covered, shards)):
            rows.append((shard, 0, pack(part)))
        requests = _requests(left, unit)
        for shard, part in by_shard(requests, doc_shard(requests, shards)):
            rows.append((shard, 1, pack(part)))
        return pa.Table.from_batches([packed_rows(rows, packed_schema())])
    return run


def _by_document(columns: Columns) -> Iterator[tuple[int, int, Columns]]:
    order = np.lexsort((columns["start"], columns["tag"], columns["doc"]))
    doc, tag = columns["doc"][order], columns["tag"][order]
    edges = np.flatnonzero((np.diff(doc) != 0) | (np.diff(tag) != 0)) + 1
    for a, b in zip(np.append(0, edges), np.append(edges, len(doc)), strict=True):
        if b > a:
            yield int(doc[a]), int(tag[a]), take(columns, order[a:b])


def _requests_by_document(group: pa.Table) -> pa.Table:
    columns = unpack(REQUEST, group.column("packed").to_pylist())
    docs, tags, packed = [], [], []
    for doc, tag, part in _by_document(columns):
        docs.append(doc)
        tags.append(tag)
        packed.append(pack(part))
    return pa.table({"doc": pa.array(docs, pa.int64()), "tag": pa.array(tags, pa.int64()),
                     "packed": pa.array(packed, pa.binary())})


def _ranges_by_document(group: pa.Table) -> pa.Table:
    columns = unpack(RANGE, group.column("packed").to_pylist())
    docs, tags, starts, ends = [], [], [], []
    for doc, tag, part in _by_document(columns):
        a = part["start"].astype(np.int64)
        a, b = merged(a, a + part["length"])
        docs.append(doc)
        tags.append(tag)
        starts.append(a)
        ends.append(b)
    return pa.table({"doc": pa.array(docs, pa.int64()), "tag": pa.array(tags, pa.int64()),
                     "starts": pa.array(starts, pa.list_(pa.int64())),
                     "ends": pa.array(ends, pa.list_(pa.int64()))})


HALF = {"doc": "i8", "tag": "i8", "start": "u4", "length": "u4"}


def _cut(unit: Unit, shards: int) -> Callable:
    """Items of the requested half segments, packed by shard of their key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for a, b, data, offsets in text_chunks(batch.column(0)):
                blobs = batch.column(1).slice(a, b - a).to_pylist()
                items, first = data, offsets
                if unit.words:
                    starts, ends, first = word_bounds(data, offsets, SPACE)
                    items = hasher.ranges(hasher.prefix(hasher.codes[data]), starts, ends)
                asked = unpack(REQUEST, blobs)
                sizes = [len(x) // row_bytes(REQUEST) for x in blobs]
                base = np.repeat(np.asarray(first[:-1]), sizes)
                rows = []
                columns = {**asked, "base": base}
                shard = (asked["key"] % np.uint64(shards)).astype(int)
                for s, part in by_shard(columns, shard):
                    n = part["length"].astype(np.int64)
                    at = np.repeat(part["base"] + part["start"] - (np.cumsum(n) - n), n) \
                        + np.arange(n.sum())
                    head = pack({c: part[c] for c in HALF})
                    rows.append((s, len(n), head + items[at].tobytes()))
                if rows:
                    yield packed_rows(rows, packed_schema())
    return run


def half_segments(group: pa.Table, unit: Unit) -> tuple[Columns, np.ndarray]:
    """The half segments of a shard and their items one after the other."""
    heads, items = [], []
    size = row_bytes(HALF)
    for n, blob in zip(group.column("kind").to_pylist(), group.column("packed").to_pylist(),
                       strict=True):
        heads.append(blob[:n * size])
        items.append(np.frombuffer(blob, dtype="u8" if unit.words else "u1", offset=n * size))
    return unpack(HALF, heads), np.concatenate(items)


def _sorted_shard(unit: Unit, shards: int, repeated: Callable) -> Callable:
    def run(group: pa.Table) -> pa.Table:
        half, items = half_segments(group, unit)
        length = half["length"].astype(np.int64)
        base = np.cumsum(length) - length
        at, label = repeated(items, length, unit.width)
        owner = np.searchsorted(base, at, side="right") - 1
        start = (half["start"][owner] + (at - base[owner])).astype(np.uint32)
        rank = start if unit.inside else np.zeros(len(at), dtype=np.uint32)
        late = np.flatnonzero(after_first(label, half["doc"][owner], rank))
        found = {"doc": half["doc"][owner[late]], "tag": half["tag"][owner[late]],
                 "start": start[late],
                 "length": np.full(len(late), unit.width, dtype=np.uint32)}
        rows = [(s, 0, pack(part)) for s, part in by_shard(found, doc_shard(found, shards))]
        return pa.Table.from_batches([packed_rows(rows, packed_schema())])
    return run


def repeated_ranges(df: DataFrame, id_column: str, text_column: str, unit: Unit,
                    repeated: Callable) -> DataFrame:
    """The table with the item ranges of each text that repeat something earlier.

    ``repeated(items, lengths, width)`` gets segments laid end to end and returns the starts of
    windows that occur more than once, and a label that equal windows share. Adds the columns
    ``starts`` and ``ends`` (arrays, null where nothing repeats), named apart from others.
    """
    spark = df.sparkSession
    shards = 4 * partitions(spark)
    doc, tag, starts, ends = fresh(df, "doc_order", "text_tag", "starts", "ends")
    keyed = df.withColumns({
        doc: F.coalesce(quoted(id_column).cast("long"), F.lit(LAST_ID)),
        tag: F.xxhash64(quoted(text_column))})
    scanned = keyed.select(doc, tag, quoted(text_column)).mapInArrow(_scan(unit, shards), PACKED)
    resolved = materialise(scanned.groupBy("shard").applyInArrow(_resolve(unit, shards), PACKED))
    asked = (resolved.where("kind = 1").groupBy("shard")
             .applyInArrow(_requests_by_document, "doc long, tag long, packed binary"))
    texts = keyed.select(F.col(doc).alias("doc"), F.col(tag).alias("tag"),
                         quoted(text_column).alias("text")).where(F.length("text") > 0)
    halves = (texts.join(asked.hint("shuffle_hash"), ["doc", "tag"]).select("text", "packed")
              .mapInArrow(_cut(unit, shards), PACKED))
    found = halves.groupBy("shard").applyInArrow(_sorted_shard(unit, shards, repeated), PACKED)
    ranges = (resolved.where("kind = 0").unionByName(materialise(found)).groupBy("shard")
              .applyInArrow(_ranges_by_document,
                            "doc long, tag long, starts array<long>, ends array<long>")
              .select(F.col("doc").alias(doc), F.col("tag").alias(tag),
                      F.col("starts").alias(starts), F.col("ends").alias(ends)))
    return keyed.join(ranges.hint("shuffle_hash"), [doc, tag], "left").drop(doc, tag)
