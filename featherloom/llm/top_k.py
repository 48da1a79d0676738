"""Exact top-k inner products with block-at-a-time pruning.

Every dimension is two terms, its positive and its negative part. Vectors lie in blocks of
consecutive ids that keep each term's maximum; a query's bound for a block is the sum of its terms
times the maxima. Per query, blocks are scored in order of falling bound through their forward
index, until the bound falls below the query's k-th score.

Ranges of blocks and chunks of queries meet in one equi-join on (range, chunk), both of bounded
size, so that every task holds one pair; k rows per query and range go on to the last ranking.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from featherloom.llm.common import materialise, partitions
from featherloom.naming import quoted

BLOCK = 64
#: Vectors of a range and queries of a chunk: what one task holds.
RANGE, CHUNK = 4096, 1024
#: Above this sum of products a score may leave the range that doubles hold exactly.
EXACT = float(1 << 52)


def quantised(vector: str, scale: int) -> F.Column:
    """floor(scale * x) of each component; null if the vector takes no part."""
    v = quoted(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (F.abs(x.cast("double")) == float("inf")))
    return F.when(~bad, F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(scale))))


def _matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids").to_pylist()
        packed, widths = [], []
        for vectors in batch.column("vectors").to_pylist():
            widths.append(max((len(v) for v in vectors), default=0))
            packed.append(_matrix(vectors, widths[-1]).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("slot"), pa.array(ids, pa.list_(pa.int64())),
             pa.array(widths, pa.int32()), pa.array(packed, pa.binary())],
            names=["slot", "ids", "width", "packed"])


def search_blocks(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray,
                  queries: np.ndarray, k: int, block: int = BLOCK
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of the k best vectors of each query, ties to smaller ids."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    n, width = vectors.shape
    count = -(-n // block)
    pad = count * block - n
    forward = np.concatenate([vectors, np.zeros((pad, width), np.int64)]).reshape(
        count, block, width)
    block_ids = np.concatenate([ids, np.zeros(pad, np.int64)]).reshape(count, block)
    real = (np.arange(count * block) < n).reshape(count, block)
    shown = np.where(real[:, :, None], forward, 0)
    up = np.maximum(shown.max(axis=1), 0).astype(np.float64)    # maxima of positive terms
    down = np.maximum((-shown).max(axis=1), 0).astype(np.float64)   # and of negative ones
    plus = np.maximum(queries, 0).astype(np.float64)
    minus = np.maximum(-queries, 0).astype(np.float64)
    bounds = plus @ up.T + minus @ down.T
    if bounds.size and bounds.max() >= EXACT:
        bounds[:] = np.inf  # a rounded bound must not prune
    ranked = np.argsort(-bounds, axis=1, kind="stable")
    best_score = np.full((len(queries), k), np.iinfo(np.int64).min)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    found = np.zeros((len(queries), k), dtype=bool)
    active = np.arange(len(queries))
    for turn in range(count):
        at = ranked[active, turn]
        kth = np.where(found[active].all(axis=1), best_score[active, -1].astype(np.float64),
                       -np.inf)
        keep = bounds[active, at] >= kth
        active, at = active[keep], at[keep]  # bounds only fall from here
        if not len(active):
            break
        for b in np.unique(at):
            who = active[at == b]
            scores = queries[who] @ forward[b].T
            usable = real[b][None, :] & (block_ids[b][None, :] != query_ids[who][:, None])
            all_ids = np.concatenate([best_id[who], np.broadcast_to(block_ids[b], scores.shape)], 1)
            all_scores = np.concatenate([best_score[who], scores], 1)
            all_found = np.concatenate([found[who], usable], 1)
            pick = np.lexsort((all_ids, -all_scores, ~all_found), axis=1)[:, :k]
            best_id[who] = np.take_along_axis(all_ids, pick, 1)
            best_score[who] = np.take_along_axis(all_scores, pick, 1)
            found[who] = np.take_along_axis(all_found, pick, 1)
    row, place = np.nonzero(found)
    return row, best_id[row, place], best_score[row, place]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                width = max(r["width"], r["query_width"])
                vectors = _widened(r["packed"], len(r["ids"]), r["width"], width)
                queries = _widened(r["query_packed"], len(r["query_ids"]), r["query_width"], width)
                query_ids = np.asarray(r["query_ids"], dtype=np.int64)
                row, ids, scores = search_blocks(np.asarray(r["ids"], dtype=np.int64), vectors,
                                                 query_ids, queries, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[row]), pa.array(ids), pa.array(scores)],
                    names=["query_id", "vec_id", "score"])
    return run


def _widened(packed: bytes, rows: int, width: int, to: int) -> np.ndarray:
    out = np.zeros((rows, to), dtype=np.int64)
    out[:, :width] = np.frombuffer(packed, dtype=np.int64).reshape(rows, width)
    return out


def _slots(df: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Runs of about ``size`` consecutive ids as one row each, and how many there are.

    Rows are dealt by range of id; places within a sorted partition cut it into slots.
    """
    n = df.count()
    parts = max(1, -(-n // size))
    ordered = df.repartitionByRange(parts, "id").sortWithinPartitions("id", "vector")
    placed = ordered.select(
        F.spark_partition_id().alias("part"), "id", "vector",
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    cut = placed.select("part", F.floor(F.col("place") / size).alias("piece"), "id", "vector")
    grouped = cut.groupBy("part", "piece").agg(
        F.collect_list("id").alias("ids"), F.collect_list("vector").alias("vectors"))
    packed = grouped.select((F.col("part") + F.col("piece") * parts).alias("slot"), "ids",
                            "vectors").mapInArrow(
        _pack, "slot long, ids array<long>, width int, packed binary")
    return materialise(packed), n


def top_k(df: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id",
          vector_column: str = "embedding", scale: int = 1024) -> DataFrame:
    """The k largest integer inner products of each query with the rows of ``df``.

    Components become floor(scale * x). Returns query_id, rank (from 1), vec_id, score; ties go to
    the smaller vec_id; a row is no candidate of queries with its own id. Fewer candidates give
    fewer rows. Rows with a null id, a null vector, or a null or non-finite component take no
    part. A shorter vector counts as padded with zeros, an empty one scores 0. Rows that share an
    id are candidates of their own; queries that share an id are one query with the first of
    their vectors in array order. Scores are 64-bit and wrap beyond that. Empty tables give an
    empty table.
    """
    spark = df.sparkSession

    def prepared(source: DataFrame) -> DataFrame:
        return source.select(quoted(id_column).cast("long").alias("id"),
                             quantised(vector_column, scale).alias("vector")).dropna()

    ranges, n = _slots(prepared(df), RANGE)
    asked = prepared(queries).groupBy("id").agg(F.min("vector").alias("vector"))
    chunks, m = _slots(asked, CHUNK)
    if not n or not m:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    slots = ranges.select("slot")
    every_range = slots.agg(F.collect_list("slot").alias("slots"))
    every_chunk = chunks.agg(F.collect_list("slot").alias("slots"))
    left = ranges.withColumn("chunk", F.explode(every_chunk.scalar()))
    right = chunks.select(F.col("slot").alias("chunk"), F.col("ids").alias("query_ids"),
                          F.col("width").alias("query_width"),
                          F.col("packed").alias("query_packed"),
                          F.explode(every_range.scalar()).alias("slot"))
    pairs = (left.repartition(4 * partitions(spark), "slot", "chunk")
             .join(right.hint("shuffle_hash"), ["slot", "chunk"]))
    found = pairs.select("ids", "width", "packed", "query_ids", "query_width",
                         "query_packed").mapInArrow(
        _search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
