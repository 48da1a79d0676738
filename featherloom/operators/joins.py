"""Equi-joins and unions on entity keys."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from featherloom.naming import quoted

# A key this many times above 1/HOT_LIMIT of all rows counts as hot, so there
# are always fewer than HOT_LIMIT hot keys and their table is safe to broadcast.
HOT_LIMIT = 1000
# Least number of salts; there are twice as many as shuffle partitions, if that is more.
HOT_SALTS = 64


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def join_features(base: DataFrame, features: Mapping[str, DataFrame],
                  key: str | Sequence[str]) -> DataFrame:
    """Left-joins one-row-per-key feature tables to ``base``, one after another.

    Every side is hash-partitioned on the same key, so ``base`` moves once.
    """
    for frame in features.values():
        base = base.join(frame, _keys(key), "left")
    return base


def rollup_child(parent: DataFrame, child_agg: DataFrame,
                 key: str | Sequence[str]) -> DataFrame:
    """Left join of a child aggregate (one row per key) to its parent."""
    return parent.join(child_agg, _keys(key), "left")


def align_aggregates(frames: Sequence[DataFrame], key: str | Sequence[str],
                     how: str = "inner") -> DataFrame:
    """One-row-per-key frames side by side; ``how`` is inner, left or outer."""
    if how == "outer":
        return outer_align(frames, key)
    first, *rest = frames
    for frame in rest:
        first = first.join(frame, _keys(key), how)
    return first


def concat_columns(frames: Sequence[DataFrame], key: str | Sequence[str]) -> DataFrame:
    """Side-by-side concat of frames that hold the same keys."""
    return align_aggregates(frames, key, "inner")


def outer_align(frames: Sequence[DataFrame], key: str | Sequence[str]) -> DataFrame:
    """Full outer alignment of one-row-per-key frames.

    A chain of full joins loses the partitioning after every step; a union
    followed by one group-by needs a single shuffle for any number of frames.
    """
    keys = _keys(key)
    named = Counter(c for f in frames for c in f.columns if c not in keys)
    twice = sorted(c for c, n in named.items() if n > 1)
    if twice:
        raise ValueError(f"columns of several frames: {twice}")
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    payload = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*[quoted(k) for k in keys]).agg(
        *[F.max(quoted(c)).alias(c) for c in payload])


def reindex(df: DataFrame, keys: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Exactly the given keys, missing where ``df`` lacks them."""
    return keys.select(*[quoted(k) for k in _keys(key)]).join(df, _keys(key), "left")


def union_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column absent from one frame is missing in its rows."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def union_train_test(train: DataFrame, test: DataFrame) -> DataFrame:
    return union_rows([train, test])


def lookup_join(rows: DataFrame, table: DataFrame, on: str | Sequence[str],
                weight: str, total: str | None = None) -> DataFrame:
    """Left join of a one-row-per-key ``table`` whose keys may be very uneven in ``rows``.

    ``weight`` is a column of ``table`` with the number of rows per key. Keys
    with more than 1/HOT_LIMIT of all rows are joined by broadcast; there are
    fewer than HOT_LIMIT of them by definition. Their rows are then spread over
    salts, so that the shuffle join of the remaining keys stays even. ``total``
    names a column of ``table`` that already holds the sum of the weights.
    """
    on = _keys(on)
    payload = [c for c in table.columns if c not in on and c not in (weight, total)]
    rows_in_all = quoted(total) if total else \
        table.agg(F.sum(quoted(weight)).alias("rows")).scalar()
    is_hot = F.coalesce(quoted(weight) > rows_in_all / F.lit(float(HOT_LIMIT)), F.lit(False))
    # The salt of other keys follows from the key. A constant would be folded into
    # the join condition, and rows would then be partitioned by the key alone.
    salts = max(HOT_SALTS, 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    own_salt = F.pmod(F.xxhash64(*[quoted(k) for k in on]), F.lit(salts))
    hot = table.filter(is_hot).select(
        *[quoted(k) for k in on],
        F.struct(*[quoted(c).alias(f"p{i}") for i, c in enumerate(payload)]).alias("__hot"))
    cold = table.filter(~is_hot).select(
        *[quoted(k) for k in on], own_salt.alias("__salt"),
        F.struct(*[quoted(c).alias(f"p{i}") for i, c in enumerate(payload)]).alias("__cold"))
    # equal rows differ by their partition, which a repeated task does not change
    plain = [quoted(c) for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    spread = F.pmod(F.xxhash64(*plain, F.spark_partition_id()), F.lit(salts)) + salts
    unmatched = quoted("__hot").isNull()
    for k in on:
        unmatched = unmatched & quoted(k).isNotNull()
    tagged = (rows.join(F.broadcast(hot), on, "left")
              .withColumn("__salt", F.when(unmatched, own_salt).otherwise(spread)))
    joined = tagged.join(cold, [*on, "__salt"], "left")
    values = [F.coalesce(quoted("__hot").getField(f"p{i}"),
                         quoted("__cold").getField(f"p{i}")).alias(c)
              for i, c in enumerate(payload)]
    return joined.select(*[quoted(c) for c in rows.columns], *values)
