"""Exact k nearest neighbours by blocks, pruned with the triangle inequality.

Train rows are assigned to the cell of a near pivot; neighbouring cells fill a block of bounded size
together, a large cell is cut into several. There are as many pivots as the square root of the rows,
in two levels: groups of pivots round a top pivot, so a row is compared with some of them only. A
query visits only the blocks that can hold one of its k nearest rows. Queries of neighbouring cells
share a chunk, and a stored row is sent to the chunks that ask for its block, to no other. A (block,
query chunk) pair is one bounded task that returns k rows per query. It goes through the block's
cells from the nearest on and leaves out those that the rows found so far rule out. The others are
compared on a grid of 64 levels per dimension, in small integers; that distance and what the
rounding took bound the exact one from below, which is computed only for pairs within the bound.
In the worst case, when no cell can be ruled out, the work is rows x queries on the grid.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT

from featherloom.functions.columns import finite, key_digest
from featherloom.ml.matrix import materialise
from featherloom.naming import quoted

BLOCK_ROWS = 65536
CHUNK_ROWS = 32768
PIVOTS = 64
#: Blocks and chunks are cut smaller for rows wider than this; chunks also to get CHUNKS of them,
#: if they keep LEAST_ROWS.
WIDTH, CHUNKS, LEAST_ROWS = 64, 24, 512
#: Levels of the grid; the gaps of four dimensions fit in 8 bits.
LEVELS = 64
#: Stored rows, an eighth of them at most, that give every query its first limit.
SAMPLE_ROWS = 8192
#: Queries compared at once, with FIRST_ROWS stored rows at first and up to PIECE_ROWS later.
TILE_ROWS, FIRST_ROWS, PIECE_ROWS = 128, 512, 8192


def _vectors(df: DataFrame, key: str, features: str, *more: str) -> DataFrame:
    x = quoted(features)
    if isinstance(df.schema[features].dataType, VectorUDT):
        x = vector_to_array(x)
    # missing coordinates count as 0, infinite ones as the largest number
    x = F.transform(x.cast("array<double>"), lambda v: finite(v, T.DoubleType()))
    return df.select(quoted(key).alias("key"), x.alias("x"),
                     *[quoted(c) for c in more])


def _distances(x: np.ndarray, y: np.ndarray, p: float) -> np.ndarray:
    """All distances of two small matrices, one dimension at a time."""
    out = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        gap = np.abs(x[:, j, None] - y[None, :, j])
        out += gap if p == 1 else gap ** p
    return out if p == 1 else out ** (1.0 / p)


def _paired(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray, p: float) -> np.ndarray:
    """Distances of the rows i of x to the rows j of y, pair by pair, as ``_distances`` has them."""
    out = np.empty(len(i))
    for start in range(0, len(i), 512):
        part = slice(start, start + 512)
        gap = x[i[part]]
        gap -= y[j[part]]
        np.abs(gap, out=gap)
        # by dimension, so that they are added in that order
        gap = np.ascontiguousarray(gap.T)
        out[part] = (gap if p == 1 else gap ** p).sum(axis=0)
    return out if p == 1 else out ** (1.0 / p)


def _grid(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(lowest level, step) of a grid that holds most of the rows; affects speed only."""
    some = x[::-(-len(x) // 4096)]
    low, high = np.quantile(some, [0.005, 0.995], axis=0)
    step = float((high - low).max(initial=0.0)) / (LEVELS - 1)
    if not 0 < step < np.inf:
        step = 1.0
    low = (low + high) / 2 - step * (LEVELS - 1) / 2
    return np.where(np.isfinite(low), low, 0.0), step


def _on_grid(x: np.ndarray, low: np.ndarray, step: float) -> tuple[np.ndarray, np.ndarray]:
    """(levels, L1 distance to them) of each row; the distance is infinite if it overflows."""
    level = np.nan_to_num(np.rint((x - low) / step)).clip(0, LEVELS - 1)
    loss = np.abs(x - (low + step * level)).sum(axis=1)
    # what the sums above may be off by
    loss += 1e-14 * (np.abs(x).sum(axis=1) + np.abs(low).sum() + step * LEVELS * x.shape[1])
    return level.astype(np.int8), np.nan_to_num(loss, nan=np.inf, posinf=np.inf)


def _grid_distances(x: np.ndarray, y: np.ndarray, less: np.ndarray) -> np.ndarray:
    """All L1 distances of two small matrices of levels, given by dimension, less one of each y."""
    out = np.repeat(-less[None, :], x.shape[1], axis=0)
    total, gap = np.empty(out.shape, np.uint8), np.empty(out.shape, np.int8)
    for first in range(0, len(x), 4):
        for j in range(first, min(first + 4, len(x))):
            into = total.view(np.int8) if j == first else gap
            np.subtract(x[j][:, None], y[j], out=into)
            np.abs(into, out=into)
            if j > first:
                np.add(total, gap.view(np.uint8), out=total)
        np.add(out, total, out=out)
    return out


def _widened(bound: np.ndarray) -> np.ndarray:
    """A bound with room for rounding errors."""
    return bound * (1 + 1e-9) + 1e-9


class Cells:
    """Pivots in two levels; each top pivot leads the group of the pivots nearest to it."""

    def __init__(self, centres: np.ndarray, p: float) -> None:
        self.centres, self.p = centres, p
        self.tops = centres[:isqrt(len(centres) - 1) + 1]
        group = _distances(centres, self.tops, p).argmin(axis=1)
        self.members = [np.flatnonzero(group == g) for g in range(len(self.tops))]

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(cell, distance to its pivot, group, distance to the top pivot) of each row."""
        to_top = _distances(x, self.tops, self.p)
        group = to_top.argmin(axis=1)
        cell, far = np.zeros(len(x), dtype=np.int64), np.zeros(len(x))
        for g in np.unique(group):
            rows = np.flatnonzero(group == g)
            d = _distances(x[rows], self.centres[self.members[g]], self.p)
            best = d.argmin(axis=1)
            cell[rows], far[rows] = self.members[g][best], d[np.arange(len(rows)), best]
        return cell, far, group, to_top[np.arange(len(x)), group]

    def measured(self, cells: np.ndarray, sizes: np.ndarray, radii: np.ndarray,
                 top_radii: np.ndarray) -> None:
        """Takes the number of rows of each cell in use, and how far they lie from both pivots."""
        self.size = np.zeros(len(self.centres), dtype=np.int64)
        self.radius = np.zeros(len(self.centres))
        top = np.zeros(len(self.centres))
        self.size[cells], self.radius[cells], top[cells] = sizes, radii, top_radii
        self.members = [m[self.size[m] > 0] for m in self.members]
        self.group_size = np.array([self.size[m].sum() for m in self.members])
        self.group_radius = np.array([top[m].max(initial=0.0) for m in self.members])

    def _reach(self, d: np.ndarray, radius: np.ndarray, size: np.ndarray, need: int) -> np.ndarray:
        """Distance within which each query surely has ``need`` rows, infinite if unknown."""
        if not d.shape[1]:
            return np.full(len(d), np.inf)
        reach = d + radius
        order = np.argsort(reach, axis=1)
        enough = np.cumsum(size[order], axis=1) >= need
        best = np.take_along_axis(reach, order, axis=1)[np.arange(len(d)), enough.argmax(axis=1)]
        return np.where(enough.any(axis=1), best, np.inf)

    def bounds(self, x: np.ndarray, need: int) -> np.ndarray:
        """Distance within which each query has ``need`` rows, by the radii of near cells."""
        to_top = _distances(x, self.tops, self.p)
        bound = self._reach(to_top, self.group_radius, self.group_size, need)
        first = to_top.argmin(axis=1)
        for g in np.unique(first):
            rows, cells = np.flatnonzero(first == g), self.members[g]
            d = _distances(x[rows], self.centres[cells], self.p)
            bound[rows] = np.minimum(bound[rows], self._reach(d, self.radius[cells],
                                                              self.size[cells], need))
        return bound

    def candidates(self, x: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Which blocks may hold a row within each query's bound, in the order of ``leads``."""
        to_top = _distances(x, self.tops, self.p)
        limit = _widened(bound)
        # a distance that overflows proves nothing
        far = np.isfinite(to_top) & (to_top - self.group_radius > limit[:, None])
        found = np.zeros((len(x), len(self.leads)), dtype=bool)
        for g, cells in enumerate(self.members):
            rows = np.flatnonzero(~far[:, g])
            if len(rows) and len(cells):
                d = _distances(x[rows], self.centres[cells], self.p)
                near = ~(np.isfinite(d) & (d - self.radius[cells] > limit[rows, None]))
                of = np.searchsorted(self.leads, self.lead[cells])
                for u in np.unique(of):
                    found[rows, u] |= near[:, of == u].any(axis=1)
        return found

    def blocks(self, block_rows: int) -> None:
        """Names the block of each cell by its first cell, ``lead``, and counts its parts."""
        self.lead = np.zeros(len(self.centres), dtype=np.int64)
        first, held = -1, 0
        for c in np.concatenate(self.members).astype(np.int64):
            if first < 0 or held + self.size[c] > block_rows:
                first, held = c, 0
            self.lead[c] = first
            held += self.size[c]
        self.leads = np.unique(self.lead[self.size > 0])
        rows = np.bincount(self.lead, weights=self.size, minlength=len(self.centres))
        self.parts = np.maximum(-(-rows.astype(np.int64) // block_rows), 1)


def _routed(t: DataFrame, q: DataFrame, need: int, p: float, pivots: int, block_rows: int,
            chunk_rows: int, seed: int) -> tuple[DataFrame, DataFrame, Cells, int] | None:
    """What ``routes`` returns, the cells, and a number of partitions for the tasks."""
    # the choice of pivots and sample affects speed only
    rows = t.count()
    count = max(pivots, isqrt(rows))
    first = t.orderBy(key_digest(F.col("key"), seed))
    found = first.limit(count).collect()
    if not found:
        return None
    cells = Cells(np.array([r["x"] for r in found]), p)
    width = max(cells.centres.shape[1], 1)
    more = min(SAMPLE_ROWS, SAMPLE_ROWS * WIDTH // width, rows // 8)
    sample = np.array([r["x"] for r in (first.limit(more).collect() if more > count else found)])

    @F.pandas_udf("home int, far double, top double")
    def home(x: pd.Series) -> pd.DataFrame:
        cell, far, _, top = cells.home(np.stack(x.to_numpy()))
        return pd.DataFrame({"home": cell.astype("int32"), "far": far, "top": top})

    t = materialise(t.withColumn("h", home("x")).select("key", "x", "h.home", "h.far", "h.top"))
    used = t.groupBy("home").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("r"),
                                 F.max("top").alias("s")).collect()
    cells.measured(*(np.array([c[name] for c in used]) for name in ("home", "n", "r", "s")))
    cells.blocks(max(1, min(block_rows, block_rows * WIDTH // width)))

    places = cells.home(sample)[0]

    @F.pandas_udf("home int, bound double, cells array<int>")
    def candidates(x: pd.Series) -> pd.DataFrame:
        x = np.stack(x.to_numpy())
        home = cells.home(x)[0]
        bound, asks = np.empty(len(x)), np.empty(len(x), dtype=object)
        order = np.argsort(home, kind="stable")
        for start in range(0, len(x), 1024):
            at = order[start:start + 1024]
            with np.errstate(over="ignore", invalid="ignore"):
                limit = cells.bounds(x[at], need)
                i, _, d = _closest(x[at], limit, sample, places, cells, None, need, need)
                last = np.arange(len(i)) - np.searchsorted(i, i) == need - 1
                limit[i[last]] = np.minimum(limit[i[last]], d[last])
                bound[at] = limit
                for n, found in zip(at, cells.candidates(x[at], limit)):
                    asks[n] = cells.leads[found].astype("int32")
        return pd.DataFrame({"home": home.astype("int32"), "bound": bound, "cells": asks})

    q = materialise(q.withColumn("h", candidates("x"))
                    .select("key", "x", "h.home", "h.bound", "h.cells"))
    # neighbouring cells fill a chunk together, a full cell takes several
    homes = q.groupBy("home").agg(F.count(F.lit(1)).alias("n")).collect()
    group = {int(c): g for g, m in enumerate(Cells(cells.centres, p).members) for c in m}
    asked_of = np.zeros(len(cells.centres), dtype=np.int64)
    for h in homes:
        asked_of[h["home"]] = h["n"]
    order = sorted(range(len(asked_of)), key=lambda c: (group[c], c))
    begin = np.zeros(len(asked_of), dtype=np.int64)
    begin[order] = np.cumsum(asked_of[order]) - asked_of[order]
    queries = int(asked_of.sum())
    chunk_rows = max(1, min(chunk_rows, chunk_rows * WIDTH // width,
                            max(LEAST_ROWS, -(-queries // CHUNKS))))

    @F.pandas_udf("int")
    def chunk_of(cell: pd.Series, digest: pd.Series) -> pd.Series:
        cell = cell.to_numpy()
        inside = (digest.to_numpy() % np.maximum(asked_of[cell], 1))
        return pd.Series(((begin[cell] + inside) // chunk_rows).astype("int32"))

    @F.pandas_udf("int")
    def lead_of(cell: pd.Series) -> pd.Series:
        return pd.Series(cells.lead[cell.to_numpy()].astype("int32"))

    @F.pandas_udf("int")
    def parts_of(cell: pd.Series) -> pd.Series:
        return pd.Series(cells.parts[cell.to_numpy()].astype("int32"))

    digest = F.pmod(F.xxhash64("key"), F.lit(1 << 62))
    asked = (q.withColumn("chunk", chunk_of("home", digest)).withColumn("cell", F.explode("cells"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), parts_of("cell") - 1)))
             .select("cell", "block", "chunk", "key", "x", "home", "bound"))
    wanted = asked.select("cell", "block", F.col("chunk").alias("for")).distinct()
    held = (t.withColumn("cell", lead_of("home"))
            .withColumn("block", F.pmod(F.xxhash64("key"), parts_of("cell")).cast("int"))
            # one row per task; a join by shuffle would deal the stored rows to a task per block
            .join(F.broadcast(wanted), ["cell", "block"])
            .select("cell", "block", F.col("for").alias("chunk"), "key", "x", "home"))
    tasks = int(cells.parts[cells.leads].sum()) * -(-queries // chunk_rows)
    return asked, held, cells, max(1, min(2 * tasks, 1000))


def routes(t: DataFrame, q: DataFrame, need: int, p: float, pivots: int, block_rows: int,
           chunk_rows: int, seed: int) -> tuple[DataFrame, DataFrame] | None:
    """(asked, held): queries and stored rows (key, x) by (cell, block, chunk); None without rows.

    A block is a part of a run of neighbouring cells, named by the first of them; ``home`` is the
    row's own cell. A stored row is held once for each chunk that asks for its block.
    """
    found = _routed(t, q, need, p, pivots, block_rows, chunk_rows, seed)
    return found and found[:2]


def _closest(x: np.ndarray, limits: np.ndarray, y: np.ndarray, home: np.ndarray, cells: Cells,
             same: Callable[[np.ndarray, np.ndarray], np.ndarray] | None, k: int,
             need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, stored row, distance) of the k nearest stored rows within each query's limit.

    Equal distances are in the order of the stored rows; pairs in ``same`` are left out, at most
    ``need - k`` of a query. ``home`` is the cell of a stored row.
    """
    p, width = cells.p, x.shape[1]
    used, place = np.unique(home, return_inverse=True)
    of_cell = np.split(np.argsort(place, kind="stable"), np.cumsum(np.bincount(place))[:-1])
    most = (LEVELS - 1) * width
    kind = np.int16 if most < 1 << 15 else np.int32
    # no L1 distance is more than this many times the other
    stretch = width ** (1 - 1 / p) if p > 1 else 1.0
    low, step = _grid(y)
    (levels, loss), (stored, lost) = _on_grid(x, low, step), _on_grid(y, low, step)
    slack = np.ceil(lost / step).clip(0, most).astype(kind)
    parts = []
    for start in range(0, len(x), TILE_ROWS):
        tile, limit = x[start:start + TILE_ROWS], limits[start:start + TILE_ROWS].copy()
        tile_levels = np.ascontiguousarray(levels[start:start + TILE_ROWS].T)
        tile_loss = loss[start:start + TILE_ROWS]
        away = _distances(tile, cells.centres[used], p)
        # a distance that overflows proves nothing
        least = np.where(np.isfinite(away), away - cells.radius[used], -np.inf)
        rest = np.concatenate([of_cell[c] for c in np.argsort(away.min(axis=0), kind="stable")])
        i, j, d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        size = FIRST_ROWS
        while True:
            open_ = ~(least > _widened(limit)[:, None]).all(axis=0)
            if not open_.all():
                rest = rest[open_[place[rest]]]
            if not len(rest):
                break
            piece, rest = rest[:size], rest[size:]
            gaps = _grid_distances(tile_levels, np.ascontiguousarray(stored[piece].T),
                                   slack[piece])
            if size == FIRST_ROWS and len(piece) >= need:
                # any ``need`` rows give a limit, those near on the grid a good one
                a, b = np.repeat(np.arange(len(tile)), need), np.argpartition(gaps, need - 1)
                exact = _paired(tile, a, y, piece[b[:, :need].ravel()], p)
                limit = np.minimum(limit, exact.reshape(-1, need).max(axis=1))
            size = min(2 * size, PIECE_ROWS)
            room = np.floor((_widened(limit) * stretch + tile_loss) / step) + 1
            room = np.nan_to_num(room, nan=most).clip(0, most).astype(kind)
            hits = np.flatnonzero(gaps <= room[:, None])
            for first in range(0, len(hits), 1 << 14):
                a, b = np.divmod(hits[first:first + (1 << 14)], len(piece))
                b = piece[b]
                exact = _paired(tile, a, y, b, p)
                good = ~(exact > limit[a])
                if same:
                    good &= ~same(start + a, b)
                i, j, d = (np.concatenate(v) for v in
                           ((i, a[good]), (j, b[good]), (d, exact[good])))
                order = np.lexsort((j, d, i))
                i, j, d = i[order], j[order], d[order]
                rank = np.arange(len(i)) - np.searchsorted(i, i)
                limit[i[rank == k - 1]] = np.minimum(limit[i[rank == k - 1]], d[rank == k - 1])
                i, j, d = i[rank < k], j[rank < k], d[rank < k]
        parts.append((start + i, j, d))
    return tuple(np.concatenate(v) for v in zip(*parts))


def nearest_rows(train: DataFrame, query: DataFrame, key: str, features: str, k: int,
                 p: float = 1, exclude_self: bool = False, pivots: int = PIVOTS,
                 block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS,
                 seed: int = 0) -> DataFrame:
    """key, neighbour, distance: the k nearest train rows of every query row.

    Equal distances are ordered by the neighbour's key. ``exclude_self`` leaves
    out the train rows with the query's own key. ``pivots`` is the least number of them; the driver
    holds the pivots, at most the square root of the rows if that is more.
    """
    t, q = _vectors(train, key, features), _vectors(query, key, features)
    key_type = t.schema["key"].dataType.simpleString()
    need = k
    if exclude_self:
        need += t.groupBy("key").count().agg(F.max("count").alias("n")).first()["n"] or 0
    found = _routed(t, q, need, p, pivots, block_rows, chunk_rows, seed)
    if found is None:
        return t.sparkSession.createDataFrame(
            [], f"key {key_type}, neighbour {key_type}, distance double")
    asked, held, cells, tasks = found

    def closest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"key": [], "neighbour": [], "distance": []})
        left = left.sort_values("home", kind="stable")
        right = right.sort_values("key", kind="stable")
        own, names = left["key"].to_numpy(), right["key"].to_numpy()

        def same(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            return own[i] == names[j]

        with np.errstate(over="ignore", invalid="ignore"):
            i, j, d = _closest(np.stack(left["x"].to_numpy()), left["bound"].to_numpy(),
                               np.stack(right["x"].to_numpy()), right["home"].to_numpy(),
                               cells, same if exclude_self else None, k, need)
        return pd.DataFrame({"key": own[i], "neighbour": names[j], "distance": d})

    by = ["cell", "block", "chunk"]
    asked, held = (df.repartition(tasks, *by) for df in (asked, held))
    local = asked.groupBy(*by).cogroup(held.groupBy(*by)).applyInPandas(
        closest, f"key {key_type}, neighbour {key_type}, distance double")
    order = Window.partitionBy("key").orderBy("distance", "neighbour")
    return (local.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= k)
            .drop("__r"))


def knn_votes(train: DataFrame, query: DataFrame, key: str, features: str, label: str,
              k: int = 5, p: float = 1, weights: str = "distance",
              exclude_self: bool = False, **blocks) -> DataFrame:
    """key, class, proba: weighted share of each class among the k nearest rows.

    With distance weights a neighbour at distance 0 outweighs all others.
    """
    near = nearest_rows(train, query, key, features, k, p, exclude_self, **blocks)
    labels = train.select(quoted(key).alias("neighbour"), quoted(label).alias("class"))
    near = near.join(labels, "neighbour")
    if weights == "distance":
        per_query = Window.partitionBy("key")
        same = F.max(F.when(F.col("distance") == 0, 1).otherwise(0)).over(per_query)
        weight = F.when(same == 1, F.when(F.col("distance") == 0, 1.0).otherwise(0.0)) \
            .otherwise(F.lit(1.0) / F.nullif(F.col("distance"), F.lit(0.0)))
    else:
        weight = F.lit(1.0)
    voted = near.withColumn("__w", weight).groupBy("key", "class").agg(F.sum("__w").alias("w"))
    share = F.col("w") / F.sum("w").over(Window.partitionBy("key"))
    return voted.select(F.col("key").alias(key), F.col("class").alias(label),
                        share.alias("proba"))


def fit_knn(train: DataFrame, params: Mapping, key: str, features: str, label: str):
    """The stored rows are the model; predicting joins the queries against them."""
    from featherloom.ml.models import Fitted

    k, p = int(params.get("n_neighbors", 5)), float(params.get("p", 2))
    weights = params.get("weights", "uniform")

    def predict(df: DataFrame, name: str) -> DataFrame:
        votes = knn_votes(train, df, key, features, label, k, p, weights)
        positive = votes.filter(quoted(label) == 1).select(quoted(key), F.col("proba").alias(name))
        joined = df.join(positive, key, "left")
        return joined.withColumn(name, F.coalesce(quoted(name), F.lit(0.0)))

    return Fitted(predict)
