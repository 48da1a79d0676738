"""Trie of the prefixes that conversations share.

A turn becomes 128 bits, a conversation the binary string of its turns, so that binary order puts
conversations with a common prefix side by side. Equal conversations are merged first, with their
number. The others are cut into ranges of that order, of bounded numbers of turns. Each range is a
task: it takes the common prefix of neighbours (in turns), builds a sparse table of range minima
over them, and every candidate prefix binary-searches its left and right extents on its own, by
halving steps through the table. The members of a prefix are then an interval, and counts, leaves
and shared tokens are differences of prefix sums. A range knows the last conversation before it and
the first one after it. Only prefixes that reach over a range's border come in pieces; pieces are
added up by the prefix's digest.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from featherloom.llm.common import materialise, partitions
from featherloom.naming import quoted
from featherloom.operators.joins import lookup_join

#: Bytes that stand for a turn.
ITEM = 16
#: Most turns of a range on average, and most turns of the place where two ranges are cut.
RANGE, CUT = 1 << 20, 64
#: Conversations of a family, and least number that a shared head cannot have.
FAMILY, HEAD = 100, 6
_NONE = hashlib.sha256(b"").hexdigest()

_PIECE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
          "n_leaves long, shared long, above long, ends_sha256 string, node binary, "
          "parent binary")


def conversation_turns(df: DataFrame, id_column: str = "conv_id", turn_column: str = "turn",
                       role_column: str = "role", text_column: str = "text") -> DataFrame:
    """(conv, path): the turns of each conversation in order, each as (item, chars).

    Null turns come first; turns of equal number, and repeated rows, follow the order of their
    digest. Null role or text becomes empty. Rows without an id belong to no conversation. The turns
    of one conversation meet in one task, as 24 bytes each; texts do not move.
    """
    role, text = (F.coalesce(quoted(c), F.lit("")) for c in (role_column, text_column))
    item = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))
    turns = df.where(quoted(id_column).isNotNull()).select(
        quoted(id_column).cast("long").alias("conv"), F.struct(
            quoted(turn_column).alias("turn"), item.alias("item"),
            F.char_length(text).cast("long").alias("chars")).alias("one"))
    path = F.transform(F.sort_array(F.collect_list("one")),
                       lambda t: F.struct(t["item"].alias("item"), t["chars"].alias("chars")))
    return turns.groupBy("conv").agg(path.alias("path"))


def with_family_heads(turns: DataFrame) -> DataFrame:
    """Conversations whose first h turns are those of the first of their hundred.

    h is the unsigned crc32 of the decimal id, modulo 6. Without that conversation there is no head;
    a shorter one gives all its turns.
    """
    first = F.col("conv") - F.col("conv") % FAMILY
    head = F.max(F.when(F.col("conv") == first, F.slice("path", 1, HEAD - 1))).over(
        Window.partitionBy("first"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEAD).cast("int")
    own = F.slice("path", h + 1, F.greatest(F.size("path") - h, F.lit(0)))
    shared = F.coalesce(F.slice(F.col("head"), F.lit(1), h), F.slice("path", 1, 0))
    return (turns.withColumn("first", first).withColumn("head", head)
            .select("conv", F.concat(shared, own).alias("path")))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, key, order, chars): the items laid end to end, and their digest."""
    for batch in batches:
        path = batch.column(1)
        offsets = path.offsets.to_numpy()
        turns = path.values
        data = b"".join(turns.field(0).to_pylist())
        orders = [data[ITEM * a:ITEM * b] for a, b in zip(offsets - offsets[0],
                                                         (offsets - offsets[0])[1:], strict=False)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([hashlib.md5(o).digest() for o in orders], pa.binary()),
             pa.array(orders, pa.binary()),
             pa.ListArray.from_arrays(path.offsets, turns.field(1))],
            names=["conv", "key", "order", "chars"])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per key of sorted (key, conv): number, least id, SHA-256 of the ids so far listed."""
    key = digest = least = None
    count, out = 0, []

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), (
                pa.int64(), pa.int64(), pa.string()), strict=True)],
            names=["conv", "copies", "ends_sha256"])
        out.clear()
        return batch

    for batch in batches:
        keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        first = 0
        while first < len(keys):
            last = bisect_right(keys, keys[first], first)
            if keys[first] != key:
                if key is not None:
                    out.append((least, count, digest.hexdigest()))
                key, digest, least, count = keys[first], hashlib.sha256(), ids[first], 0
            elif count:
                digest.update(b",")
            digest.update(",".join(map(str, ids[first:last])).encode())
            count += last - first
            first = last
        if out:
            yield flush()
    if key is not None:
        out.append((least, count, digest.hexdigest()))
        yield flush()


class RangeMinima:
    """Sparse table: the least of 2^k values from each place, for all k."""

    def __init__(self, values: np.ndarray) -> None:
        self.n, self.levels = len(values), [values]
        while (1 << len(self.levels)) <= self.n:
            below, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(below[:-half], below[half:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least value of each first..last, both included."""
        out = np.empty(len(first), dtype=self.levels[0].dtype)
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][first[at]],
                                 self.levels[k][last[at] - (1 << int(k)) + 1])
        return out

    def right(self, place: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Last place up to which all values after ``place`` are at least ``bound``."""
        for k in range(len(self.levels) - 1, -1, -1):
            fits = place + (1 << k) < self.n
            at = np.where(fits, place + 1, 0)
            place = place + ((fits & (self.levels[k][at] >= bound)).astype(np.int64) << k)
        return place

    def left(self, place: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """First place from which all values up to ``place``, itself without, are at least
        ``bound`` when each value belongs to the step from the place before it."""
        for k in range(len(self.levels) - 1, -1, -1):
            fits = place - (1 << k) >= 0
            at = np.where(fits, place - (1 << k) + 1, 0)
            place = place - ((fits & (self.levels[k][at] >= bound)).astype(np.int64) << k)
        return place


def common_prefixes(orders: list[bytes]) -> np.ndarray:
    """Turns that each conversation shares with the one before it (the first: none)."""
    sizes = np.array([len(o) // ITEM for o in orders], dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    halves = np.frombuffer(b"".join(orders), dtype=np.uint64).reshape(-1, 2)
    out = np.zeros(len(orders), dtype=np.int64)
    rows, depth = np.arange(1, len(orders)), 0
    while len(rows):
        rows = rows[np.minimum(sizes[rows], sizes[rows - 1]) > depth]
        same = (halves[first[rows] + depth] == halves[first[rows - 1] + depth]).all(1)
        rows, depth = rows[same], depth + 1
        out[rows] = depth
    return out


def _digests(order: bytes, depth: int) -> list[bytes]:
    """Digest of the prefix of each number of turns up to ``depth``."""
    digest = hashlib.md5()
    out = [digest.digest()]
    for i in range(depth):
        digest.update(order[ITEM * i:ITEM * (i + 1)])
        out.append(digest.digest())
    return out


def range_nodes(orders: list[bytes], chars: list[np.ndarray], least: np.ndarray,
                copies: np.ndarray, ends: list[str], before: bytes | None,
                after: bytes | None) -> dict[str, object]:
    """Nodes of sorted distinct conversations, as columns of ``_PIECE``.

    ``before`` and ``after`` are the conversations next to the range, or None at the table's ends.
    ``shared`` is the sum, over all members but a node's first, of the characters they share with
    the member before them, counted from the start; ``above`` those of the node's parent.
    Nodes that go over a border are named by ``node``, children of such nodes name their ``parent``.
    """
    n = len(orders)
    sizes = np.array([len(o) // ITEM for o in orders], dtype=np.int64)
    start = np.cumsum(sizes + 1) - (sizes + 1)
    # characters of the first d turns of conversation p lie at start[p] + d
    steps = np.zeros(int(sizes.sum()) + n, dtype=np.int64)
    inner = np.ones(len(steps), dtype=bool)
    inner[start] = False
    steps[inner] = np.concatenate(chars) if n else steps[:0]
    total = np.cumsum(steps)
    total -= np.repeat(total[start], sizes + 1)

    lcp = common_prefixes(orders)
    into = common_prefixes([before, orders[0]])[1] if before is not None else -1
    onto = common_prefixes([orders[-1], after])[1] if after is not None else -1
    table = RangeMinima(lcp)

    # candidates: every prefix at the first conversation that has it
    from_depth = lcp + 1
    from_depth[0] = 0
    counts = sizes - from_depth + 1
    offset = np.cumsum(counts) - counts
    place = np.repeat(np.arange(n), counts)
    depth = np.arange(len(place)) - offset[place] + from_depth[place]
    goes_in = (place == 0) & (depth <= into)
    last = table.right(place, depth)

    # each step from a conversation to the next opens a child of the prefix that they share
    joints = np.arange(1, n)
    home = table.left(joints, lcp[1:])
    owner = offset[home] + lcp[1:] - from_depth[home]
    children = np.bincount(owner, minlength=len(place))
    opens = ~goes_in & (sizes[place] > depth)
    if into >= 0:
        opens[into] |= sizes[0] > into
    parent = np.arange(len(place)) - 1
    parent[offset[1:]] = owner

    shared_at = total[start + np.where(np.arange(n) == 0, max(into, 0), lcp)]
    own = shared_at + (copies - 1) * total[start + sizes]
    shared = np.concatenate([[0], np.cumsum(own)])
    members = np.concatenate([[0], np.cumsum(copies)])
    leaf = np.append(lcp[1:], onto) < sizes
    leaves = np.concatenate([[0], np.cumsum(leaf)])
    is_open = goes_in | ((last == n - 1) & (depth <= onto))
    smallest = RangeMinima(least).least(place, last)

    full = (depth == sizes[place]) & ~goes_in
    ends_of = np.full(len(place), None, dtype=object)
    ends_of[full] = np.array(ends, dtype=object)[place[full]]
    node = np.full(len(place), None, dtype=object)
    on_first, on_last = _digests(orders[0], max(into, 0)), _digests(orders[-1], max(onto, 0))
    for i in np.flatnonzero(is_open).tolist():
        node[i] = on_first[depth[i]] if goes_in[i] else on_last[depth[i]]
    below_open = (parent >= 0) & is_open[parent]
    return {
        "conv_id": smallest, "depth": depth,
        "parent_conv_id": np.where((parent >= 0) & ~below_open, smallest[parent], -1),
        "known": (parent >= 0) & ~below_open,
        "n_convs": members[last + 1] - members[place], "n_children": children + opens,
        "n_leaves": leaves[last + 1] - leaves[place],
        "shared": shared[last + 1] - shared[place] - np.where(goes_in, 0, shared_at[place]),
        "above": np.where(depth > 0, total[start[place] + np.maximum(depth - 1, 0)], 0),
        "ends_sha256": ends_of, "node": node,
        "parent": np.where(below_open, node[parent], None)}


def _pieces(conversations: pa.Table, borders: pa.Table) -> pa.Table:
    rows = conversations.to_pydict()
    by_order = sorted(range(len(rows["order"])), key=rows["order"].__getitem__)
    chars = conversations.column("chars").combine_chunks()
    values, offsets = chars.values.to_numpy(), chars.offsets.to_numpy()
    found = range_nodes(
        [rows["order"][i] for i in by_order],
        [values[offsets[i]:offsets[i + 1]] for i in by_order],
        np.array([rows["conv"][i] for i in by_order], dtype=np.int64),
        np.array([rows["copies"][i] for i in by_order], dtype=np.int64),
        [rows["ends_sha256"][i] for i in by_order],
        borders.column("before")[0].as_py(), borders.column("after")[0].as_py())
    known = found.pop("known")
    types = {"ends_sha256": pa.string(), "node": pa.binary(), "parent": pa.binary()}
    return pa.table({name: pa.array(values, pa.int64(), mask=~known)
                     if name == "parent_conv_id" else pa.array(values, types.get(name, pa.int64()))
                     for name, values in found.items()})


def _in_ranges(cuts: list[bytes]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect_right(cuts, o) for o in batch.column("order").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())],
                                             names=[*batch.schema.names, "range"])
    return run


def _cut_places(distinct: DataFrame) -> list[bytes]:
    """Places between ranges: the heads of conversations drawn by digest, about one per range.

    There are as many ranges as partitions, more where a range would exceed RANGE turns. A head has
    at most CUT turns; conversations with equal heads of that length stay in one range.
    """
    turns, rows = distinct.agg(F.sum(F.length("order") / ITEM), F.count(F.lit(1))).first()
    ranges = max(partitions(distinct.sparkSession), int((turns or 0) // RANGE))
    drawn = F.pmod(F.xxhash64("key"), F.lit(max(1, rows // ranges))) == 0
    heads = distinct.where(drawn).select(F.substring("order", 1, CUT * ITEM).alias("head"))
    # each cut is the head of a conversation, so no range between two cuts is empty
    return sorted(bytes(r["head"]) for r in heads.distinct().collect())[1:]


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv, path of (item, chars)); ids must be distinct.

    A node is a distinct sequence of first turns, the root the empty one; its members are the
    conversations that start with it. Returns conv_id (least member), depth, parent_conv_id (of
    the parent; null for the root), n_convs, n_children, n_leaves (nodes without children in its
    subtree), saved_tokens (over its subtree, characters of each last turn for every member but one)
    and ends_sha256 (hash of the ids of members without further turns, ascending, comma-joined).
    Conversations may be empty. An empty table gives an empty table.
    """
    n = partitions(turns.sparkSession)
    packed = materialise(turns.mapInArrow(_packed, "conv long, key binary, order binary, "
                                                   "chars array<long>"))
    ends = (packed.select("key", "conv").repartition(n, "key").sortWithinPartitions("key", "conv")
            .mapInArrow(_ends, "conv long, copies long, ends_sha256 string"))
    distinct = materialise(packed.join(ends, "conv"))
    placed = materialise(distinct.select("conv", "order", "chars", "copies", "ends_sha256")
                         .mapInArrow(_in_ranges(_cut_places(distinct)),
                                     "conv long, order binary, chars array<long>, copies long, "
                                     "ends_sha256 string, range long"))
    spans = materialise(placed.groupBy("range").agg(F.min("order").alias("low"),
                                                    F.max("order").alias("high")))
    borders = (spans.select("range")
               .join(spans.select((F.col("range") + 1).alias("range"),
                                  F.col("high").alias("before")), "range", "left")
               .join(spans.select((F.col("range") - 1).alias("range"),
                                  F.col("low").alias("after")), "range", "left"))
    pieces = materialise(placed.groupBy("range").cogroup(borders.groupBy("range"))
                         .applyInArrow(_pieces, _PIECE))
    whole = pieces.where(F.col("node").isNull())
    joined = materialise(
        pieces.where(F.col("node").isNotNull()).groupBy("node", "depth").agg(
            F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in (
                "n_convs", "n_children", "n_leaves", "shared")],
            F.max("above").alias("above"), F.max("ends_sha256").alias("ends_sha256"),
            F.max("parent").alias("parent")))
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "shared", "above",
               "ends_sha256"]
    parents = joined.select(F.col("node").alias("parent"), F.col("conv_id").alias(
        "parent_conv_id"), F.col("n_children").alias("children"))
    inner = whole.where(F.col("parent").isNull()).select(*columns, "parent_conv_id")
    outer = lookup_join(whole.where(F.col("parent").isNotNull()).select(*columns, "parent")
                        .unionByName(joined.select(*columns, "parent")), parents, "parent",
                        "children").select(*columns, "parent_conv_id")
    saved = F.col("shared") - (F.col("n_convs") - 1) * F.col("above")
    return inner.unionByName(outer).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        saved.alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_NONE)).alias("ends_sha256"))


def trie_digest(df: DataFrame) -> DataFrame:
    """Nodes over the conversations with the heads of their families."""
    return prefix_trie(with_family_heads(conversation_turns(df)))
