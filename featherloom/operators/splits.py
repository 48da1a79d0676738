"""Reproducible row splits for validation; they do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from featherloom.functions.columns import key_digest
from featherloom.naming import quoted
from featherloom.operators.rank import digest_row_number, numbered_digests, ordered_row_number


def kfold(df: DataFrame, key: str, k: int, seed: int = 42, name: str = "fold") -> DataFrame:
    """Adds a fold from 0 to k-1; fold sizes differ by at most 1."""
    return _fold(digest_row_number(df, key, seed, "__i"), k, name)


def stratified_kfold(df: DataFrame, key: str, target: str, k: int, seed: int = 42,
                     name: str = "fold") -> DataFrame:
    """Like kfold within each class."""
    return _fold(digest_row_number(df, key, seed, "__i", by=[target]), k, name)


def _fold(numbered: DataFrame, k: int, name: str) -> DataFrame:
    return numbered.withColumn(name, ((F.col("__i") - 1) % k).cast("int")).drop("__i")


def _size(share: float | int, rows: Column, up: bool) -> Column:
    """Rows of a part: an absolute number, or a share rounded up or down."""
    if isinstance(share, int):
        return F.lit(share).cast("long")
    exact = F.round(rows * F.lit(float(share)), 9)
    return F.ceil(exact) if up else F.floor(exact)


def _role(test_size: float | int, train_size: float | int | None) -> Column:
    test = _size(test_size, F.col("__t"), up=True)
    train = F.col("__t") - test if train_size is None else _size(train_size, F.col("__t"), False)
    return (F.when(F.col("__i") <= test, F.lit("valid"))
            .when(F.col("__i") <= test + train, F.lit("train")))


def shuffle_split(df: DataFrame, key: str, n_splits: int, test_size: float | int,
                  train_size: float | int | None = None, seed: int = 42,
                  name: str = "split") -> DataFrame:
    """Adds ``{name}_{i}`` per split: train, valid, or missing for unused rows."""
    return _roles(df, key, [], n_splits, test_size, train_size, seed, name)


def _roles(df: DataFrame, key: str, by: list[str], n_splits: int, test_size: float | int,
           train_size: float | int | None, seed: int, name: str) -> DataFrame:
    """All splits at once: one ranking of the (split, key) pairs and one join back.

    Rows of one key are told apart by their number; their roles are dealt in any order.
    """
    keys = [quoted(c).alias(f"__by{i}") for i, c in enumerate(by)]
    digests = F.array(*[F.struct(F.lit(s).alias("__split"), key_digest(quoted(key), seed + s)
                                 .alias("__digest")) for s in range(n_splits)])
    tall = df.select(quoted(key).alias("__key"), *keys, F.explode(digests).alias("__one")).select(
        "__key", *[f"__by{i}" for i in range(len(by))], "__one.*")
    ranked = numbered_digests(tall, "__digest", "__key", "__i",
                              ["__split", *[f"__by{i}" for i in range(len(by))]], "__t")
    role = ranked.withColumn("__role", _role(test_size, train_size))
    nth = Window.partitionBy("__key", "__split").orderBy("__i")
    wide = (role.withColumn("__nth", F.row_number().over(nth)).groupBy("__key", "__nth").agg(*[
        F.max(F.when(F.col("__split") == s, F.col("__role"))).alias(f"{name}_{s}")
        for s in range(n_splits)]))
    mine = df.withColumn("__nth", F.row_number().over(
        Window.partitionBy(quoted(key)).orderBy(*[quoted(c) for c in by] or [quoted(key)])))
    match = quoted(key).eqNullSafe(F.col("__key")) & (F.col("__nth") == F.col("__mth"))
    return mine.join(wide.withColumnRenamed("__nth", "__mth"), match, "left").drop(
        "__nth", "__mth", "__key")


def stratified_shuffle_split(df: DataFrame, key: str, target: str, n_splits: int,
                             test_size: float, train_size: float | None = None,
                             seed: int = 42, name: str = "split") -> DataFrame:
    """Like shuffle_split with the shares taken within each class."""
    return _roles(df, key, [target], n_splits, test_size, train_size, seed, name)


def time_series_split(df: DataFrame, key: str, order_by: str, k: int,
                      name: str = "block", seed: int = 0) -> DataFrame:
    """Adds a block number: rows of block i validate fold i, all before it train.

    Block 0 is only ever trained on. Each of the last k blocks has n // (k+1)
    rows, the first takes the remainder.
    """
    df = ordered_row_number(df, order_by, key, "__i", seed, total="__t")
    size = F.floor(F.col("__t") / (k + 1))
    first = F.col("__t") - size * k
    block = F.when(F.col("__i") <= first, 0).otherwise(
        F.floor((F.col("__i") - first - 1) / F.greatest(size, F.lit(1))) + 1)
    return df.withColumn(name, block.cast("int")).drop("__i", "__t")


def time_series_fold(df: DataFrame, i: int, name: str = "block",
                     ) -> tuple[DataFrame, DataFrame]:
    """(train, valid) rows of fold i, i from 1."""
    return df.filter(quoted(name) < i), df.filter(quoted(name) == i)
