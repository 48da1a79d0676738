"""Near duplicates by SimHash: fingerprints of 64 bits, searched by BK-trees.

A BK-tree keys the children of a node by their integer Hamming distance to it; a search follows
only the edges whose distance lies within the radius of its own distance to the node. Fingerprints
within r bits agree in at least one of r + 1 groups of bits, so a shard is the set of fingerprints
that agree in one group: each fingerprint lies in r + 1 shards, each shard has its own tree, and
all members of a shard search it. A shard that is too large for a tree is cut again by r + 1 groups
of its free bits, until it fits; with few free bits it must. No pair is lost and no tree meets
fingerprints that cannot be near.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from featherloom.llm.common import materialise, partitions
from featherloom.llm.components import components
from featherloom.naming import quoted
from featherloom.operators.joins import lookup_join

#: Words of a shingle, differing bits of a link.
SHINGLE, RADIUS = 3, 2
#: Most fingerprints of a tree.
TREE = 1 << 14
#: Fingerprints whose trees a task builds at once; hashes whose bits it counts at once; pairs of
#: a search and a node that it follows at once.
FOREST, HASHES, FRONT = 1 << 15, 1 << 17, 1 << 18
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALL = (1 << 64) - 1


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """XXH64 (seed 42) of each run of ``shingle`` words; all words of a shorter text at once."""
    words = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(r"[^\x20\x09-\x0D]+"),
                                 F.lit(0))

    def hashed(words: Column) -> Column:
        at = F.slice(words, F.lit(1), F.greatest(F.size(words) - (shingle - 1), F.lit(0)))
        return F.when(F.size(words) >= shingle, F.transform(at, lambda word, i: F.xxhash64(
            F.concat_ws(" ", word, *[F.get(words, i + j) for j in range(1, shingle)])))) \
            .when(F.size(words) > 0, F.array(F.xxhash64(F.concat_ws(" ", words)))) \
            .otherwise(F.array().cast("array<long>"))
    # bound to a variable, so the words are taken apart once
    return F.get(F.transform(F.array(F.coalesce(words, F.array().cast("array<string>"))),
                             hashed), 0)


def majority(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each run of hashes, the bits that more than half of them have."""
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    counts = np.diff(offsets)
    ones = np.zeros((len(counts), 64), dtype=np.int64)
    first = 0
    while first < len(counts):
        last = int(np.searchsorted(offsets, offsets[first] + HASHES, side="right")) - 1
        last = min(max(last, first + 1), len(counts))
        for a in range(offsets[first], offsets[last], HASHES):   # one text may need several
            b = min(a + HASHES, offsets[last])
            bits = np.unpackbits(values[a:b].view(np.uint8).reshape(-1, 8), axis=1,
                                 bitorder="little")
            starts = np.clip(offsets[first:last], a, b) - a
            full = np.flatnonzero(np.minimum(offsets[first + 1:last + 1], b)
                                  > np.maximum(offsets[first:last], a))
            ones[first + full] += np.add.reduceat(bits, starts[full], axis=0, dtype=np.int64)
        first = last
    return ((2 * ones > counts[:, None]) * weights).sum(1, dtype=np.uint64)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = batch.column(1)
        offsets = hashes.offsets.to_numpy().astype(np.int64)
        values = hashes.values.to_numpy(zero_copy_only=False)
        bits = majority(np.ascontiguousarray(values).view(np.uint64), offsets)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))],
                                         names=["doc_id", "bits"])


def fingerprints(df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, bits) of every row; the 64 bits as a long, zero for texts without words."""
    return df.select(quoted(id_column).cast("long").alias("doc_id"),
                     shingle_hashes(quoted(text_column), shingle).alias("hashes")
                     ).mapInArrow(_fingerprints, "doc_id long, bits long")


class Forest:
    """BK-trees of many shards at once; rows of a shard lie together."""

    def __init__(self, bits: np.ndarray, shard: np.ndarray) -> None:
        self.bits = bits
        opens = np.ones(len(bits), dtype=bool)
        opens[1:] = shard[1:] != shard[:-1]
        self.root = np.flatnonzero(opens)[np.cumsum(opens) - 1]
        #: Child of each (node, distance), or -1.
        self.child = np.full(len(bits) * 65, -1, dtype=np.int32)
        rows, at = np.flatnonzero(~opens), self.root[~opens]
        while len(rows):
            slot = at * 65 + self.distance(rows, at)
            taken, first, inverse = np.unique(slot, return_index=True, return_inverse=True)
            self.child[taken] = rows[first]
            below = np.ones(len(rows), dtype=bool)
            below[first] = False
            rows, at = rows[below], rows[first][inverse[below]]

    def distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.bits[a] ^ self.bits[b]).astype(np.int64)

    def _search(self, rows: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        fronts = [(rows, self.root[rows])]
        while fronts:
            row, node = fronts.pop()
            if len(row) > FRONT:
                half = len(row) // 2
                fronts += [(row[:half], node[:half]), (row[half:], node[half:])]
                continue
            far = self.distance(row, node)
            hit = (far <= radius) & (row > node)
            yield row[hit], node[hit]
            rows, nodes = [], []
            for edge in range(-radius, radius + 1):
                at = far + edge
                fits = (at >= 0) & (at <= 64)
                below = np.where(fits, self.child[node * 65 + np.clip(at, 0, 64)], -1)
                found = below >= 0
                rows.append(row[found])
                nodes.append(below[found].astype(np.int64))
            row, node = np.concatenate(rows), np.concatenate(nodes)
            if len(row):
                fronts.append((row, node))

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of rows of one shard within the radius, the later row first, in portions."""
        yield from self._search(np.arange(len(self.bits)), radius)


def spanning(n: int, links: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Least row that the links reach from each of n rows."""
    least = np.arange(n)
    for a, b in links:
        while True:
            x, y = least[a], least[b]
            apart = x != y
            if not apart.any():
                break
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
            while (least != (further := least[least])).any():
                least = further
    return least


def _trees(radius: int) -> Callable:
    """Links of sorted shards: (a, b) from each fingerprint to the first of its cluster."""
    def links(mask: np.ndarray, value: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
        shard = np.ones(len(bits), dtype=np.int64)
        shard[1:] = (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])
        shard = np.cumsum(shard)
        many = np.bincount(shard)[shard] > 1
        bits, shard = bits[many], shard[many]
        least = spanning(len(bits), Forest(bits.view(np.uint64), shard).links(radius))
        moved = np.flatnonzero(least != np.arange(len(bits)))
        return pa.RecordBatch.from_arrays(
            [pa.array(bits[moved]), pa.array(bits[least[moved]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, 0), dtype=np.int64)
        for batch in batches:
            held = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
            if held.shape[1] < FOREST:
                continue
            # the last shard may go on in the next batch
            same = (held[0] == held[0, -1]) & (held[1] == held[1, -1])
            end = len(same) - int(same.sum())
            if end:
                yield links(*held[:, :end])
                held = held[:, end:]
        if held.shape[1]:
            yield links(*held)
    return run


def _parts(fixed: int, radius: int) -> list[int]:
    """Masks that fix, besides ``fixed``, one of radius + 1 groups of the free bits."""
    free = [i for i in range(64) if not fixed >> i & 1]
    cuts = [len(free) * i // (radius + 1) for i in range(radius + 2)]
    return [fixed | sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _shards(distinct: DataFrame, radius: int, tree: int) -> DataFrame:
    """(mask, value, bits): the fingerprints of each shard; shards above ``tree`` are cut again."""
    masks, done = _parts(0, radius), []

    def under(df: DataFrame, options: Column) -> DataFrame:
        cut = df.select("bits", F.explode(options).alias("mask"))
        return cut.select("mask", F.col("mask").bitwiseAND(F.col("bits")).alias("value"), "bits")

    shards = under(distinct, F.array(*[F.lit(_signed(m)).cast("long") for m in masks]))
    while True:
        # with this few free bits no shard can be too large
        if min(64 - m.bit_count() for m in masks) < tree.bit_length():
            break
        large = materialise(shards.groupBy("mask", "value").count().where(F.col("count") > tree))
        if large.isEmpty():
            break
        keys = large.select("mask", "value", F.lit(True).alias("large"))
        marked = materialise(shards.join(keys, ["mask", "value"], "left"))
        done.append(marked.where(F.col("large").isNull()).drop("large"))
        finer = {m: _parts(m, radius) for m in masks}
        options = F.create_map(*[c for m, parts in finer.items() for c in (
            F.lit(_signed(m)).cast("long"),
            F.array(*[F.lit(_signed(p)).cast("long") for p in parts]))])
        shards = under(marked.where("large"), options[F.col("mask")])
        masks = sorted({p for parts in finer.values() for p in parts})
    for part in done:
        shards = shards.unionByName(part)
    return shards


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """(a, b): links that join all fingerprints ``bits`` that chains of near pairs join.

    ``distinct`` holds each fingerprint once. A tree yields, of all pairs that it finds within
    ``radius`` bits, one link from each fingerprint to the first of its cluster.
    """
    n = partitions(distinct.sparkSession)
    return (_shards(distinct, radius, tree).repartition(n, "mask", "value")
            .sortWithinPartitions("mask", "value", "bits")
            .mapInArrow(_trees(radius), "a long, b long"))


def simhash_classes(df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Classes of rows that chains of near fingerprints join: one row per row of the input.

    Returns doc_id, bits (the fingerprint as a long), component_id (least id of the class). Shingles
    count as often as they occur; a bit is one if more than half of their hashes have it. A shorter
    text is one shingle; null, empty and wordless texts have fingerprint zero, which links like any
    other. Null ids are no least id, so a class without ids has a null component; repeated rows are
    repeated. Other columns are not read. An empty table gives an empty table.
    """
    rows = materialise(fingerprints(df, id_column, text_column, shingle))
    distinct = materialise(rows.groupBy("bits").agg(F.min("doc_id").alias("least"),
                                                    F.count(F.lit(1)).alias("n")))
    rooted = components(fingerprint_links(distinct.select("bits"), radius)).select(
        F.col("node").alias("bits"), "root")
    linked = materialise(distinct.join(rooted, "bits"))
    least = linked.groupBy("root").agg(F.min("least").alias("component"))
    of_linked = linked.join(least, "root").select("bits", F.struct("component").alias("found"))
    classes = distinct.join(of_linked, "bits", "left").select(
        "bits", "n", F.when(F.col("found").isNotNull(), F.col("found.component"))
        .otherwise(F.col("least")).alias("component_id"))
    return lookup_join(rows, materialise(classes), "bits", "n")


def simhash_digest(df: DataFrame) -> DataFrame:
    """One row per document: fingerprint in hexadecimal and least id of its class."""
    return simhash_classes(df).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
