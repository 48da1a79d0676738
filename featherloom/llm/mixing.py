"""Mixes sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Documents of a source fall into shards by a seeded hash and stand there in seeded order. The words
of a (source, shard) pair, end to end, are cut into blocks of nearly ``BLOCK`` words. Blocks are
apportioned to sources, and a source's blocks to its shards, by highest quotients; a pair takes
whole passes over its blocks and spreads the remaining quota over them from a seeded phase.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from featherloom.llm.common import fresh, materialise
from featherloom.naming import quoted

#: Words of a block.
BLOCK = 32
#: Documents that a shard should hold over all sources, and the most shards.
SHARD_ROWS, MAX_SHARDS = 1000, 4096
#: Times its size that a source, and a document, may be taken.
MOST = 3
#: Columns that a mix adds.
ADDED = ("size", "source_size", "target", "taken", "copies", "spans")
#: Weights of the sources in code point order, repeating (fixed values).
WEIGHTS = (1, 2, 3)


def word_count(text: Column) -> Column:
    """Number of runs without space, tab or line ends; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def apportion(votes: np.ndarray, house: int, caps: np.ndarray) -> np.ndarray:
    """Sainte-Laguë seats: each goes to the highest quotient votes / (2 * seats + 1) of those
    below their cap; ties to the first. Seats beyond all caps stay free."""
    votes, caps = votes.astype(np.float64), caps.astype(np.int64)
    house = int(min(house, caps[votes > 0].sum()))
    seats = np.zeros(len(votes), dtype=np.int64)
    if house <= 0:
        return seats

    def at(divisor: float) -> np.ndarray:
        return np.minimum(caps, np.floor(np.minimum(votes / divisor, 2.0 ** 60) + 0.5)
                          .astype(np.int64))

    low, high = 0.0, 2 * float(votes.max()) + 1  # high gives no seat at all
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if at(middle).sum() > house:
            low = middle
        else:
            high = middle
    seats = at(high)
    while seats.sum() < house:
        quotient = np.where((seats < caps) & (votes > 0), votes / (2 * seats + 1), -1.0)
        seats[int(np.argmax(quotient))] += 1
    return seats


def target_words(sizes: np.ndarray, weights: np.ndarray, most: int = MOST) -> np.ndarray:
    """Shares of all words by weight; what is above ``most`` sizes is shared again by weight."""
    total, limit = float(sizes.sum()), most * sizes.astype(np.float64)
    full = np.zeros(len(sizes), dtype=bool)
    while True:
        rest, free = total - limit[full].sum(), ~full
        share = np.where(free, rest * weights / max(weights[free].sum(), 1), limit)
        above = free & (share > limit)
        if not above.any():
            return share
        full |= above


def _source_quotas(weights: tuple[int, ...]):
    def run(group: pa.Table) -> pa.Table:
        """One row per source: pre-aggregated, so it grows with the sources only."""
        rows = group.to_pylist()
        rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
        sizes = np.array([r["words"] for r in rows], dtype=np.int64)
        blocks = np.array([r["blocks"] for r in rows], dtype=np.int64)
        by_rank = np.array([weights[i % len(weights)] for i in range(len(rows))], dtype=np.float64)
        targets = target_words(sizes, by_rank)
        wanted = np.divide(targets * blocks, sizes, out=np.zeros(len(rows)), where=sizes > 0)
        quotas = apportion(wanted, round(float(wanted.sum())), MOST * blocks)
        return pa.table({"key": pa.array([r["key"] for r in rows], pa.string()),
                         "source_size": pa.array(sizes), "target": pa.array(targets),
                         "quota": pa.array(quotas)})
    return run


def _shard_quotas(group: pa.Table) -> pa.Table:
    """Quota of each shard of one source; a source has at most MAX_SHARDS rows here."""
    order = np.argsort(group.column("shard").to_numpy(), kind="stable")
    group = group.take(pa.array(order))
    blocks = group.column("blocks").to_numpy()
    quotas = apportion(blocks, group.column("quota")[0].as_py(), MOST * blocks)
    return pa.table({"key": group.column("key"), "shard": group.column("shard"),
                     "words": group.column("words"), "blocks": group.column("blocks"),
                     "source_size": group.column("source_size"), "target": group.column("target"),
                     "quota": pa.array(quotas, pa.int64())})


def row_keys(*columns: Column) -> list[Column]:
    """128 bits of hash that stand for a row."""
    return [F.xxhash64(F.lit(i), *columns) for i in (0, 1)]


def mix_plan(df: DataFrame, seed: int = 0, id_column: str = "doc_id", text_column: str = "text",
             source_column: str = "source", weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """What the mix takes of each row, without the texts: id, k1 and k2 (hashes of the row), size,
    source_size, target, taken, copies, spans. See ``mix``."""
    id_name, text = quoted(id_column), quoted(text_column)
    source = quoted(source_column).cast("string")
    k1, k2 = row_keys(id_name, source, text)
    sized = materialise(df.select(
        id_name.alias("id"), source.alias("source"), word_count(text).alias("size"),
        k1.alias("k1"), k2.alias("k2"), F.xxhash64(F.lit(seed), id_name, text).alias("order"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("key")))
    shards = min(MAX_SHARDS, max(1, -(-sized.count() // SHARD_ROWS)))
    sized = sized.withColumn("shard", F.pmod(F.col("order"), F.lit(shards)).cast("int"))
    pairs = sized.groupBy("key", "shard").agg(F.first("source").alias("source"),
                                              F.sum("size").alias("words"))
    pairs = materialise(pairs.withColumn("blocks", F.when(F.col("words") > 0, F.greatest(
        F.lit(1), F.round(F.col("words") / BLOCK))).otherwise(0).cast("long")))
    totals = pairs.groupBy("key").agg(F.first("source").alias("source"),
                                      F.sum("words").alias("words"),
                                      F.sum("blocks").alias("blocks"))
    sources = (totals.groupBy(F.lit(0).alias("all")).applyInArrow(
        _source_quotas(weights), "key string, source_size long, target double, quota long"))
    quotas = pairs.select("key", "shard", "words", "blocks").join(sources, "key").groupBy(
        "key").applyInArrow(_shard_quotas, "key string, shard int, words long, blocks long, "
                                           "source_size long, target double, quota long")
    quotas = materialise(quotas)
    inside = Window.partitionBy("key", "shard").orderBy("order", "k1", "k2").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    planned = (sized.withColumn("end", F.sum("size").over(inside))
               .withColumn("start", F.col("end") - F.col("size"))
               .join(quotas.withColumnRenamed("words", "pair_words"), ["key", "shard"]))
    rest = F.pmod(F.col("quota"), F.greatest("blocks", F.lit(1)))
    phase = F.pmod(F.xxhash64(F.lit(seed), "key", "shard"), F.greatest("blocks", F.lit(1)))
    planned = planned.withColumns({"rest": rest, "phase": phase, "copies": F.when(
        F.col("blocks") > 0, F.floor(F.col("quota") / F.greatest("blocks", F.lit(1)))
    ).otherwise(0).cast("int")})
    found = planned.select("id", "k1", "k2", "size", "source_size", "target", "copies",
                           _spans().alias("spans"))
    taken = F.col("size") * F.col("copies") + F.aggregate(
        "spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.withColumn("taken", taken)


def mix(df: DataFrame, seed: int = 0, id_column: str = "doc_id", text_column: str = "text",
        source_column: str = "source", weights: tuple[int, ...] = WEIGHTS,
        names: Sequence[str] = ADDED) -> DataFrame:
    """Adds to each row what the mix takes of it, in columns called ``names``.

    size: words of the text; source_size and target: of its source; taken: words taken, repeats
    counted; copies: times that all of the text is taken; spans: array of (start, end) word ranges
    taken once more. ``taken`` is at most 3 sizes. The sources' targets share all words by weight
    and stop at 3 sizes, as ``target_words`` says; a source's taken words differ from its target by
    rounding to blocks.

    Null or empty text has size 0 and is never taken. A null source is a source of its own, the
    last. Rows equal in id, text and source share their places in any order. Same rows and seed
    give the same mix, however rows are partitioned. Input columns with names of added ones are
    replaced. An empty table gives an empty table.
    """
    lower = [n.lower() for n in names]
    df = df.select(*[quoted(c) for c in df.columns if c.lower() not in lower])
    plan = mix_plan(df, seed, id_column, text_column, source_column, weights)
    keys = fresh(df, "mix_k1", "mix_k2", "mix_nth")
    # repeated rows are told apart by their number only
    plan = plan.withColumn("nth", F.row_number().over(
        Window.partitionBy("k1", "k2").orderBy("taken", F.to_json("spans"))))
    plan = plan.select(*[F.col(c).alias(k) for c, k in zip(("k1", "k2", "nth"), keys,
                                                           strict=True)],
                       *[F.col(a).alias(n) for a, n in zip(ADDED, names, strict=True)])
    k1, k2 = row_keys(quoted(id_column), quoted(source_column).cast("string"),
                      quoted(text_column))
    keyed = df.withColumns({keys[0]: k1, keys[1]: k2})
    keyed = keyed.withColumn(keys[2], F.row_number().over(
        Window.partitionBy(keys[0], keys[1]).orderBy(keys[0])))
    return keyed.join(plan, keys).drop(*keys)


def _spans() -> Column:
    """Word ranges of the document inside blocks that the rest of the quota selects.

    Block i holds the pair's words floor(i * words / blocks) up to the next block's; it is
    selected where (i * rest + phase) / blocks passes a whole number.
    """
    words, blocks = F.col("pair_words"), F.col("blocks")

    def edge(i: Column) -> Column:
        return F.call_function("div", i * words, blocks)

    first = F.call_function("div", F.col("start") * blocks, words)
    last = F.call_function("div", (F.col("end") - 1) * blocks, words) + 1

    def step(i: Column) -> Column:
        return F.call_function("div", i * F.col("rest") + F.col("phase"), blocks)

    touched = F.filter(
        F.sequence(first, last),
        lambda i: (step(i + 1) > step(i)) & (edge(i + 1) > F.col("start"))
        & (edge(i) < F.col("end")) & (i < blocks))
    spans = F.transform(touched, lambda i: F.struct(
        (F.greatest(edge(i), F.col("start")) - F.col("start")).alias("start"),
        (F.least(edge(i + 1), F.col("end")) - F.col("start")).alias("end")))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return F.when((F.col("size") > 0) & (F.col("rest") > 0), spans).otherwise(none)


def mix_digest(df: DataFrame, seed: int = 0) -> DataFrame:
    """The mix without texts: one row per document."""
    return mix_plan(df, seed).select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                                     "taken")
