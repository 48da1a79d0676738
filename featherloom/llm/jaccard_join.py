"""Exact n-gram Jaccard join with token-combination prefixes.

A document is its set of shingle hashes. All documents with one set are one node. With ``t`` the
shingles a node may lack (``size - ceil(similarity * size)``), two linked nodes share a signature if
each takes tokens in one global order until its signatures survive the loss of any ``t`` tokens: a
rare token is a signature of its own, and tokens of a frequent class count in combinations of two,
so a class with m tokens in the prefix withstands m - 2 losses. Prefixes get longer for that.

The order puts common tokens (boilerplate) last: those whose count in a sketch of fixed size, over all
texts, stands far above its mean cell. Of the others a fixed share (a fifth at 0.9), chosen by hash,
comes first and by rising count of nodes; exact counts of these suffice for most prefixes, others go
on with uncounted ones. The plan:

1. tally: every task adds its tokens to a sketch, the sketches are summed, and the cells of common
   tokens go to all tasks as bits;
2. scan: sets, nodes, and their counted tokens, packed by shard of the token;
3. count: tokens of two or more nodes go back to their nodes;
4. sign: prefixes; nodes that share a signature are joined to a leader, first within the task;
5. verify: nodes of one candidate component and near size meet in blocks of bounded size, which
   compute overlaps and give a spanning forest of the links;
6. components of the links.

Tokens and sets compare by 64 bits of hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import log

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from featherloom.llm.common import materialise, partitions
from featherloom.llm.components import components
from featherloom.llm.kernels import LOWER, SPACE, Hasher, mix, text_chunks, whole_windows, word_bounds
from featherloom.llm.repeats import (LAST_ID, PACKED, by_shard, pack, packed_rows, packed_schema,
                                     unpack)
from featherloom.naming import quoted

SHINGLE = 3
#: Tokens are counted one in so many times 100 - percent, rounded up: about twice what a prefix
#: takes where the tokens are rare.
COUNTED = 45
#: Nodes that make a token frequent.
FREQUENT = 64
#: Classes of frequent tokens, by hash.
CLASSES = 16
#: Sets up to this size have one class of frequent tokens; those that can link with a larger set
#: sign with all classes too.
SMALL = 64
#: Bits of a cell number in the sketch, and its rows.
CELL_BITS, SKETCH_ROWS = 20, 2
#: Cells of the sketch that travel as one row.
STRETCH_BITS = 14
#: A token is common from FREQUENT plus so many mean cells on.
ABOVE_MEAN = 4
#: Nodes of a block in verification.
BLOCK = 1024
#: Tokens that a scan task holds before it sends them on.
FLUSH = 2_000_000

DOC = {"doc": "i8", "tag": "i8", "node": "u8", "size": "u4"}
TOKEN = {"token": "u8", "node": "u8"}
CELL = {"cell": "u4", "count": "i8"}
RETURNED = {"node": "u8", "token": "u8", "count": "u1"}
SIGNED = {"signature": "u8", "node": "u8"}


def shingle_sets(texts: pa.Array, hasher: Hasher, shingle: int = SHINGLE
                 ) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    for _, _, data, offsets in text_chunks(texts):
        data = LOWER[data]
        starts, ends, first = word_bounds(data, offsets, SPACE)
        prefix = hasher.prefix(hasher.ranges(hasher.prefix(hasher.codes[data]), starts, ends))
        grams = hasher.grams(prefix, shingle)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= shingle:
                yield np.unique(grams[a:b - shingle + 1])
            elif b > a:
                yield hasher.ranges(prefix, np.array([a]), np.array([b]))
            else:
                yield np.zeros(0, dtype=np.uint64)


def node_of(tokens: np.ndarray) -> int:
    """64-bit digest of a set; below 2^63, so that it is a positive long."""
    total = np.array([mix(tokens ^ np.uint64(0xA24BAED4963EE407)).sum(dtype=np.uint64)])
    return int(mix(total + np.uint64(len(tokens)))[0] >> np.uint64(1))


def may_lack(size: int, percent: int) -> int:
    return size - -(-percent * size // 100)


def counted(tokens: np.ndarray, percent: int) -> np.ndarray:
    return mix(tokens) % np.uint64(-(-COUNTED // (100 - percent))) == 0


def cells(tokens: np.ndarray, row: int) -> np.ndarray:
    """Cell of each token in a row of the sketch; the rows use different bits of the hash."""
    low = np.uint64((1 << CELL_BITS) - 1)
    return ((tokens >> np.uint64(44 if row == 0 else 8)) & low).astype(np.int64)


def is_common(tokens: np.ndarray, common: np.ndarray) -> np.ndarray:
    """True where every row of the sketch has a common cell for the token."""
    return np.logical_and.reduce([common[r][cells(tokens, r)] for r in range(SKETCH_ROWS)])


def _tally(shingle: int) -> Callable:
    """Counts of the sketch over the texts of a task; of equal texts one counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, known = Hasher(), set()
        counts = np.zeros((SKETCH_ROWS, 1 << CELL_BITS), dtype=np.int64)
        for batch in batches:
            new = []
            for tag in batch.column(0).to_pylist():
                new.append(tag not in known)
                known.add(tag)
            known = set() if len(known) > FLUSH else known
            for _, _, data, offsets in text_chunks(batch.column(1).filter(pa.array(new))):
                data = LOWER[data]
                starts, ends, first = word_bounds(data, offsets, SPACE)
                words = hasher.ranges(hasher.prefix(hasher.codes[data]), starts, ends)
                tokens = hasher.grams(hasher.prefix(words), shingle)
                tokens = tokens[whole_windows(first, shingle, len(starts))[:len(tokens)]]
                for r in range(SKETCH_ROWS):
                    counts[r] += np.bincount(cells(tokens, r), minlength=1 << CELL_BITS)
        flat = counts.reshape(-1)
        cell = np.flatnonzero(flat)
        rows = [(s, 0, pack(p)) for s, p in by_shard(
            {"cell": cell.astype(np.uint32), "count": flat[cell]}, cell >> STRETCH_BITS)]
        yield packed_rows(rows, packed_schema())
    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the stretches of cells that come to this task, one row each; batches stream through."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for stretch, blob in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(),
                                 strict=True):
            total = sums.setdefault(stretch, np.zeros(1 << STRETCH_BITS, dtype=np.int64))
            part = unpack(CELL, [blob])
            total[part["cell"] & np.uint32((1 << STRETCH_BITS) - 1)] += part["count"]
    rows = [(s, 0, np.minimum(t, 2 ** 32 - 1).astype("u4").tobytes()) for s, t in sums.items()]
    yield packed_rows(rows, packed_schema())


def common_cells(keyed: DataFrame, shingle: int) -> np.ndarray:
    """Bits of the cells whose count stands above the threshold, one line per row of the sketch.

    The driver gets the summed sketch: 2^20 counts of 4 bytes for each of two rows, whatever the
    size of the table.
    """
    summed = (keyed.select("tag", "text").where(F.col("text").isNotNull())
              .mapInArrow(_tally(shingle), PACKED)
              .repartition(partitions(keyed.sparkSession), "shard").mapInArrow(_summed, PACKED))
    counts = np.zeros(SKETCH_ROWS << CELL_BITS, dtype=np.uint32)
    for row in summed.select("shard", "packed").toLocalIterator():
        at = row["shard"] << STRETCH_BITS
        counts[at:at + (1 << STRETCH_BITS)] = np.frombuffer(row["packed"], dtype="u4")
    mean = counts.sum(dtype=np.float64) / len(counts)
    return (counts >= FREQUENT + ABOVE_MEAN * mean).reshape(SKETCH_ROWS, -1)


def _scan(shards: int, percent: int, shingle: int, common: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, known = Hasher(), set()
        tokens, nodes, docs, heads, held = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            rows = []
            if docs:
                table = np.array(docs, dtype=[(n, t) for n, t in DOC.items()])
                columns = {n: table[n] for n in DOC}
                shard = (columns["node"] % np.uint64(shards)).astype(int)
                rows += [(s, 2, pack(p)) for s, p in by_shard(columns, shard)]
            for node, size, total, plain, frequent in heads:
                rows.append((node % shards, 3, np.array(
                    [node, size, total, len(plain)], dtype="u8").tobytes()
                    + plain.tobytes() + frequent.tobytes()))
            if tokens:
                token = np.concatenate(tokens)
                node = np.repeat(np.array(nodes, dtype=np.uint64), [len(t) for t in tokens])
                order = np.argsort(token, kind="stable")
                token, node = token[order], node[order]
                edges = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
                count = np.diff(np.append(edges, len(token)))
                # frequent in this task alone: settled here, and one marker tells the others
                many = np.repeat(count >= FREQUENT, count)
                sure = {"node": node[many], "token": token[many],
                        "count": np.full(many.sum(), FREQUENT, dtype=np.uint8)}
                rows += [(s, 4, pack(p)) for s, p in by_shard(
                    sure, (sure["node"] % np.uint64(shards)).astype(int))]
                marked = token[edges[count >= FREQUENT]]
                rows += [(s, 5, pack(p)) for s, p in by_shard(
                    {"token": marked}, (marked % np.uint64(shards)).astype(int))]
                rest = {"token": token[~many], "node": node[~many]}
                rows += [(s, 1, pack(p)) for s, p in by_shard(
                    rest, (rest["token"] % np.uint64(shards)).astype(int))]
            tokens.clear(), nodes.clear(), docs.clear(), heads.clear()
            return packed_rows(rows, packed_schema())

        for batch in batches:
            doc = batch.column(0).to_pylist()
            tag = batch.column(1).to_pylist()
            for d, t, each in zip(doc, tag, shingle_sets(batch.column(2), hasher, shingle),
                                  strict=True):
                size = len(each)
                node = node_of(each) if size else 0
                docs.append((d, t, node, size))
                if not size or node in known:
                    continue
                known.add(node)
                first, often = counted(each, percent), is_common(each, common.value)
                own = each[first & ~often]
                need = max(0, may_lack(size, percent) + 1 + CLASSES - len(own))
                plain = each[~first & ~often][:need]
                heads.append((node, size, len(own), plain, each[often][:need - len(plain)]))
                tokens.append(own)
                nodes.append(node)
                held += len(own)
            if held >= FLUSH or len(docs) >= FLUSH:
                yield flush()
                held = 0
                known = set() if len(known) > FLUSH else known
        yield flush()
    return run


def _count(shards: int) -> Callable:
    """Sends tokens that several nodes have back to the nodes, with their count; the rest stays."""
    def run(group: pa.Table) -> pa.Table:
        kinds, blobs = group.column("kind").to_pylist(), group.column("packed").to_pylist()
        entry = unpack(TOKEN, [b for b, k in zip(blobs, kinds, strict=True) if k == 1])
        marked = np.unique(unpack({"token": "u8"}, [
            b for b, k in zip(blobs, kinds, strict=True) if k == 5])["token"])
        order = np.lexsort((entry["node"], entry["token"]))
        token, node = entry["token"][order], entry["node"][order]
        new = np.ones(len(token), dtype=bool)
        new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        token, node = token[new], node[new]
        edges = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else \
            np.zeros(0, dtype=int)
        count = np.diff(np.append(edges, len(token)))
        count = np.minimum(count, FREQUENT)
        count[np.isin(token[edges], marked)] = FREQUENT
        count = np.repeat(count, np.diff(np.append(edges, len(token))))
        several = count > 1
        back = {"node": node[several], "token": token[several],
                "count": count[several].astype(np.uint8)}
        rows = [(s, 4, pack(p)) for s, p in by_shard(
            back, (back["node"] % np.uint64(shards)).astype(int))]
        shard = group.column("shard")[0].as_py()
        rows += [(shard, k, b) for b, k in zip(blobs, kinds, strict=True) if k in (2, 3, 4)]
        return pa.Table.from_batches([packed_rows(rows, packed_schema())])
    return run


def _pair(a: int, b: int) -> int:
    return ((a * 0x9E3779B97F4A7C15) ^ (b * 0xC2B2AE3D27D4EB4F + 0x165667B19E3779F9)) \
        & 0xFFFFFFFFFFFFFFFF


def signatures(size: int, total: int, shared: list[tuple[int, int]], rest: list[int],
               percent: int, common: list[int] = ()) -> set[int]:
    """Signatures of a set: of its ``total`` counted tokens, ``shared`` has (count, token) of those
    that other nodes have too; ``rest`` are its first uncounted tokens in order, and ``common`` its
    first common ones. A set of one token links with no other set."""
    out: set[int] = set()
    ordered = [*sorted(shared), *((0, t) for t in rest), *((FREQUENT, t) for t in common)]
    unique = total - len(shared)  # first in the order, and nobody else's
    need = may_lack(size, percent) + 1
    if 1 < size <= SMALL:
        out |= _prefix_signatures(ordered, need - unique, 1)
    if size > 1 and 100 * size >= percent * SMALL:
        out |= _prefix_signatures(ordered, need - unique, CLASSES)
    return out


def _prefix_signatures(ordered: list[tuple[int, int]], need: int, classes: int) -> set[int]:
    """Single rare tokens, and pairs of frequent ones of a class, that outlast need - 1 losses."""
    out: set[int] = set()
    members: list[list[int]] = [[] for _ in range(classes)]
    for count, token in ordered:
        if need <= 0:
            break
        if count < FREQUENT:
            out.add(_pair(token, 2))
            need -= 1
        else:
            same = members[token >> 32 & (classes - 1)]
            same.append(token)
            need -= len(same) > 1
    for same in members:
        out.update(_pair(_pair(a, b), 3) for a, b in combinations(sorted(same), 2))
    return out


def _leaders(signature: np.ndarray, node: np.ndarray) -> tuple[dict, dict]:
    """(edges from nodes to the least node with the same signature, one entry per signature)."""
    order = np.lexsort((node, signature))
    signature, node = signature[order], node[order]
    new = np.ones(len(signature), dtype=bool)
    new[1:] = signature[1:] != signature[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(node)), 0)) if len(node) else \
        np.zeros(0, dtype=int)
    leader = node[head]
    other = leader != node
    edges = np.unique(np.stack([node[other], leader[other]]), axis=1)
    return ({"a": edges[0], "b": edges[1]},
            {"signature": signature[new], "node": node[new]})


def _sign(shards: int, percent: int) -> Callable:
    def run(group: pa.Table) -> pa.Table:
        kinds, blobs = group.column("kind").to_pylist(), group.column("packed").to_pylist()
        back = unpack(RETURNED, [b for b, k in zip(blobs, kinds, strict=True) if k == 4])
        order = np.argsort(back["node"], kind="stable")
        node, token, count = (back[c][order] for c in ("node", "token", "count"))
        heads = {}
        for blob, kind in zip(blobs, kinds, strict=True):
            if kind == 3:
                head = np.frombuffer(blob, dtype="u8")
                heads[int(head[0])] = head
        signature, of = [], []
        for name, head in heads.items():
            a, b = np.searchsorted(node, np.uint64(name), "left"), \
                np.searchsorted(node, np.uint64(name), "right")
            if a == b and int(head[2]) > may_lack(int(head[1]), percent):
                continue  # enough tokens that no other node has
            # a token settled in several tasks comes once from each
            shared = {t: c for t, c in sorted(zip(token[a:b].tolist(), count[a:b].tolist(),
                                                  strict=True))}
            signs = signatures(int(head[1]), int(head[2]),
                               [(c, t) for t, c in shared.items()],
                               head[4:4 + int(head[3])].tolist(), percent,
                               head[4 + int(head[3]):].tolist())
            signature += signs
            of += [name] * len(signs)
        edges, entries = _leaders(np.array(signature, dtype=np.uint64),
                                  np.array(of, dtype=np.uint64))
        rows = [(s, 0, pack(p)) for s, p in by_shard(
            edges, (edges["a"] % np.uint64(shards)).astype(int))]
        rows += [(s, 1, pack(p)) for s, p in by_shard(
            entries, (entries["signature"] % np.uint64(shards)).astype(int))]
        return pa.Table.from_batches([packed_rows(rows, packed_schema())])
    return run


def _meet(group: pa.Table) -> pa.Table:
    kinds, blobs = group.column("kind").to_pylist(), group.column("packed").to_pylist()
    own = unpack({"a": "u8", "b": "u8"}, [b for b, k in zip(blobs, kinds, strict=True) if not k])
    entry = unpack(SIGNED, [b for b, k in zip(blobs, kinds, strict=True) if k])
    edges, _ = _leaders(entry["signature"], entry["node"])
    return pa.table({c: pa.array(np.concatenate([own[c], edges[c]]).astype(np.int64))
                     for c in ("a", "b")})


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc = unpack(DOC, batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc["doc"]), pa.array(doc["tag"].astype(np.int64)),
             pa.array(doc["node"].astype(np.int64)), pa.array(doc["size"].astype(np.int64))],
            names=["doc", "tag", "node", "size"])


def linked_forest(sets: list[np.ndarray], percent: int, home: np.ndarray) -> list[tuple[int, int]]:
    """Links that join all sets that are joined by links; two sets away from home are not compared.

    A processed set is compared with all others at once, by counting the overlaps of its tokens.
    Sets outside the largest group are processed, so every pair in different groups is compared.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    token = np.concatenate(sets)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    group = np.arange(n)
    done = np.zeros(n, dtype=bool)
    links = []
    while True:
        counts = np.bincount(group, minlength=n)
        waiting = np.flatnonzero(~done & ((group != counts.argmax()) | (counts.max() == 1)))
        if not len(waiting) or counts.max() == n:
            return links
        x = int(waiting[0])
        done[x] = True
        a, b = np.searchsorted(token, sets[x], "left"), np.searchsorted(token, sets[x], "right")
        length = b - a
        at = np.repeat(a - (np.cumsum(length) - length), length) + np.arange(length.sum())
        common = np.bincount(owner[at], minlength=n)
        near = 100 * common >= percent * (sizes + sizes[x] - common)
        near &= home | home[x]
        for y in np.flatnonzero(near & (group != group[x])).tolist():
            if group[y] != group[x]:
                links.append((x, y))
                group[group == group[y]] = group[x]


def _verify(percent: int) -> Callable:
    def run(group: pa.Table) -> pa.Table:
        roots, names = (group.column(c).to_numpy() for c in ("root", "node"))
        order = np.lexsort((names, roots))
        new = np.ones(len(order), dtype=bool)
        new[1:] = np.diff(names[order]) != 0   # equal texts of a node come once
        order = order[new]
        group, roots, names = group.take(pa.array(order)), roots[order], names[order]
        sets = [np.frombuffer(b, dtype="u8") for b in group.column("tokens").to_pylist()]
        home = np.array(group.column("home").to_pylist(), dtype=bool)
        edges = np.append(0, np.append(np.flatnonzero(np.diff(roots)) + 1, len(roots)))
        links = [(a + x, a + y) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(),
                                                strict=True)
                 for x, y in linked_forest(sets[a:b], percent, home[a:b])]
        return pa.table({"a": pa.array([int(names[x]) for x, _ in links], pa.int64()),
                         "b": pa.array([int(names[y]) for _, y in links], pa.int64())})
    return run


def _tokens(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            sets = list(shingle_sets(batch.column(0), hasher, shingle))
            right = [node_of(s) == n for s, n in zip(sets, batch.column(1).to_pylist(),
                                                     strict=True)]
            out = pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([s.tobytes() for s in sets], pa.binary())],
                names=[*batch.schema.names[1:], "tokens"])
            yield out.filter(pa.array(right))
    return run


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    percent: int = 90, shingle: int = SHINGLE) -> DataFrame:
    """Classes of documents that chains of links join: one row per row of the input.

    Two documents link if 100 * common shingles >= ``percent`` * all shingles of both. Returns
    doc_order (the id, or the greatest long for null), text_tag (xxhash64 of the text),
    n_shingles, component_id (least id of the class; the row's own id if nothing links) and
    class_root (hash that names the class; null without shingles). Ids may be null or repeat, so
    only class_root tells classes apart.

    A text of fewer than ``shingle`` words, but not none, has them as its one shingle. Null and
    empty texts have no shingles and link with nothing. A null id comes after all others and is
    returned as null. Repeated rows are equal in all columns. An empty table gives an empty table.
    ``percent`` must be from 51 to 99.
    """
    keyed = df.select(F.coalesce(quoted(id_column).cast("long"), F.lit(LAST_ID)).alias("doc"),
                      F.xxhash64(quoted(text_column)).alias("tag"),
                      quoted(text_column).alias("text"))
    documents, candidates = candidate_pairs(keyed, percent, shingle)
    grouped = components(candidates)
    links = components(_verified(keyed, documents, grouped, percent, shingle))
    nodes = documents.where("size > 0").groupBy("node").agg(F.min("doc").alias("least"))
    rooted = nodes.join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    classes = rooted.join(least, "root").select("node", "component", "root")
    own = F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("doc"))
    return (documents.join(classes, "node", "left")
            .select(F.col("doc").alias("doc_order"), F.col("tag").alias("text_tag"),
                    F.col("size").alias("n_shingles"), F.nullif(own, F.lit(LAST_ID))
                    .alias("component_id"), F.col("root").alias("class_root")))


def candidate_pairs(keyed: DataFrame, percent: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(documents with node and size, pairs (a, b) of nodes that join all that share a signature)
    for rows of doc, tag (xxhash64 of the text) and text."""
    spark, shards = keyed.sparkSession, partitions(keyed.sparkSession)
    common = spark.sparkContext.broadcast(common_cells(keyed, shingle))
    scanned = materialise(keyed.mapInArrow(_scan(shards, percent, shingle, common), PACKED)
                          .groupBy("shard").applyInArrow(_count(shards), PACKED))
    documents = materialise(scanned.where("kind = 2").select("packed").mapInArrow(
        _documents, "doc long, tag long, node long, size long"))
    signed = scanned.where("kind in (3, 4)").groupBy("shard").applyInArrow(
        _sign(shards, percent), PACKED)
    return documents, signed.groupBy("shard").applyInArrow(_meet, "a long, b long")


def _verified(keyed: DataFrame, documents: DataFrame, grouped: DataFrame, percent: int,
              shingle: int) -> DataFrame:
    """Links among nodes of one candidate component, as a spanning forest of each block.

    A component of up to BLOCK nodes is verified whole, many of them in one task. A larger one is
    cut into bands of sizes that at most the next band can link with, and bands into blocks.
    """
    spark = keyed.sparkSession
    band = F.floor(F.log(F.col("size")) / F.lit(-log(percent / 100)) + 1e-9).cast("long")
    chosen = (documents.where("size > 0").groupBy("node")
              .agg(F.min(F.struct("doc", "tag")).alias("one"), F.first("size").alias("size"))
              .join(grouped, "node"))
    count = chosen.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    chosen = materialise(chosen.join(count, "root").select(
        "node", "root", F.col("one.doc").alias("doc"), F.col("one.tag").alias("tag"),
        F.when(F.col("members") > BLOCK, band).otherwise(F.lit(-1).cast("long")).alias("band")))
    large = chosen.where("band >= 0")
    crowd = large.groupBy("root", "band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    above = crowd.select("root", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    below = crowd.select("root", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))

    def meeting(at: F.Column, i: F.Column, j: F.Column, home: bool) -> F.Column:
        return F.struct(at.alias("at"), i.cast("long").alias("i"), j.cast("long").alias("j"),
                        F.lit(home).alias("home"))

    def numbers(n: str) -> F.Column:
        return F.when(F.col(n).isNotNull(), F.sequence(F.lit(0).cast("long"), F.col(n) - 1)) \
            .otherwise(F.array().cast("array<long>"))

    # within a band each block meets itself and every other; the band above meets all its blocks
    block = F.col("block")
    meetings = F.concat(
        F.transform(numbers("blocks"), lambda i: meeting(
            F.col("band"), F.least(block, i), F.greatest(block, i), True)),
        F.transform(numbers("above"), lambda i: meeting(F.col("band") + 1, -1 - block, i, False)),
        F.transform(numbers("below"), lambda i: meeting(F.col("band"), -1 - i, block, True)))
    banded = (large.join(crowd, ["root", "band"]).join(above, ["root", "band"], "left")
              .join(below, ["root", "band"], "left")
              .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
              .select("doc", "tag", "node", "root", F.col("root").alias("task"),
                      meetings.alias("meetings")))
    whole = F.pmod(F.xxhash64("root"), F.lit(16 * partitions(spark)))
    small = chosen.where("band < 0").select(
        "doc", "tag", "node", "root", whole.alias("task"),
        F.array(meeting(F.lit(-1).cast("long"), F.lit(0), F.lit(0), True)).alias("meetings"))
    placed = banded.unionByName(small)
    texts = keyed.where(F.length("text") > 0).join(placed.hint("shuffle_hash"), ["doc", "tag"])
    sets = texts.select("text", "node", "root", "task", "meetings").mapInArrow(
        _tokens(shingle), "node long, root long, task long, meetings "
        "array<struct<at:bigint,i:bigint,j:bigint,home:boolean>>, tokens binary")
    return (sets.withColumn("meet", F.explode("meetings"))
            .select("node", "tokens", "root", "task", "meet.*").groupBy("task", "at", "i", "j")
            .applyInArrow(_verify(percent), "a long, b long"))


def near_duplicate_digest(df: DataFrame) -> DataFrame:
    """One row per document: size of its set and the least id of its class."""
    out = near_duplicates(df)
    return out.select(F.nullif("doc_order", F.lit(LAST_ID)).alias("doc_id"), "n_shingles",
                      "component_id")
