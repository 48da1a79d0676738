"""Category encoders: dummy columns, integer codes, class weights."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from featherloom.ml.matrix import materialise
from featherloom.naming import dummy_name, quoted
from featherloom.operators.joins import lookup_join
from featherloom.operators.rank import ordered_row_number
from featherloom.operators.schema import categorical_columns, check_columns
from featherloom.report import Report, ensure

# A column with more values than this cannot become dummy columns.
MAX_CATEGORIES = 2000


class TooManyCategories(ValueError):
    """A column has too many distinct values to become columns."""


def discover_categories(df: DataFrame, columns: Sequence[str],
                        limit: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted distinct values of every column, found in one pass.

    The distinct (column, value) pairs are reduced on the executors; at most
    ``limit`` values per column reach the driver, more raise an error.
    """
    if not columns:
        return {}
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), quoted(c).cast("string").alias("v"))
                      for i, c in enumerate(columns)])
    distinct = (df.select(F.explode(pairs).alias("p")).select("p.i", "p.v")
                .filter(F.col("v").isNotNull()).distinct())
    rows = distinct.limit(limit * len(columns) + 1).collect()
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in rows:
        found[columns[r["i"]]].append(r["v"])
    for c, values in found.items():
        if len(values) > limit or len(rows) > limit * len(columns):
            raise TooManyCategories(f"{c}: over {limit} values in {list(columns)}")
        values.sort()
    return found


def one_hot(df: DataFrame, columns: Sequence[str] | None = None,
            nan_as_category: bool = True,
            categories: Mapping[str, Sequence[str]] | None = None,
            report: Report | None = None, limit: int = MAX_CATEGORIES,
            ) -> tuple[DataFrame, list[str], list[str]]:
    """One 0/1 column per sorted value, plus ``_nan``; sources are dropped.

    Returns (table, new columns, source columns). ``None`` or an empty list
    takes all string columns. Given ``categories`` no job runs. More than ``limit``
    values of a column are an error. Where a value is called ``nan`` itself, the
    column of the missing value is called ``_null``.
    """
    report = ensure(report)
    present, absent = check_columns(df, columns or categorical_columns(df))
    for c in absent:
        report.skip("one_hot", c, "absent column")
    known = dict(categories or {})
    known.update(discover_categories(df, [c for c in present if c not in known], limit))
    made: dict[str, Column] = {}
    for c in present:
        text = quoted(c).cast("string")
        for v in known[c]:
            made[dummy_name(c, v)] = F.when(text == F.lit(v), 1).otherwise(0)
        if nan_as_category:
            name = dummy_name(c, None)
            made[f"{c}_null" if name in made else name] = F.when(text.isNull(), 1).otherwise(0)
    kept = [quoted(c) for c in df.columns if c not in set(present)]
    return df.select(*kept, *[e.alias(n) for n, e in made.items()]), list(made), present


def _as_text(df: DataFrame, column: str) -> Column:
    """The value as a string, equal where values are; -0.0 is 0.0."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (quoted(column) + F.lit(0.0).cast(kind)).cast("string")
    return quoted(column).cast("string")


def category_codes(df: DataFrame, columns: Sequence[str], order_by: str) -> DataFrame:
    """column (its number), value (as a string), code, n: the codes of all columns as one table.

    Codes follow the first appearance by ``order_by`` within a column, ties the digest of the value.
    ``df`` is read once; the counts and the codes are written, so nothing else reads it again.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("column"), _as_text(df, c).alias("value"))
                      for i, c in enumerate(columns)])
    tall = df.select(quoted(order_by).alias("first"), F.explode(pairs).alias("pair"))
    counted = materialise(
        tall.select("first", "pair.*").where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.min("first").alias("first"),
                                        F.count(F.lit(1)).alias("n")))
    numbered = ordered_row_number(counted, "first", "value", "__row", by=["column"])
    return materialise(numbered.select(
        "column", "value", (F.col("__row") - 1).cast("int").alias("code"), "n"))


def factorize(df: DataFrame, columns: Sequence[str], order_by: str,
              report: Report | None = None) -> DataFrame:
    """Replaces each column by integer codes from 0; missing becomes -1."""
    report = ensure(report)
    present, absent = check_columns(df, sorted(columns))
    for c in absent:
        report.skip("factorize", c, "absent column")
    if not present:
        return df
    codes, names = category_codes(df, present, order_by), df.columns
    df = df.withColumns({f"__value_{i}": _as_text(df, c) for i, c in enumerate(present)})
    for i in range(len(present)):
        table = codes.where(F.col("column") == i).select(
            F.col("value").alias(f"__value_{i}"), F.col("code").alias(f"__code_{i}"),
            F.col("n").alias("__n"))
        df = lookup_join(df, table, f"__value_{i}", "__n")
    place = {c: i for i, c in enumerate(present)}
    return df.select(*[F.coalesce(quoted(f"__code_{place[c]}"), F.lit(-1)).alias(c)
                       if c in place else quoted(c) for c in names])


def class_weights(df: DataFrame, target: str, name: str = "class_weight",
                  ) -> DataFrame:
    """Adds the balanced weight rows / (classes * rows of the class).

    Up to MAX_CATEGORIES classes become a constant, so no row moves; more are joined.
    """
    counts = (df.filter(quoted(target).isNotNull()).groupBy(quoted(target))
              .agg(F.count(F.lit(1)).alias("__n")))
    found = counts.limit(MAX_CATEGORIES + 1).collect()
    if not found:
        return df.withColumn(name, F.lit(None).cast("double"))
    if len(found) <= MAX_CATEGORIES:
        rows, kind = sum(n for _, n in found), df.schema[target].dataType
        known = F.map_from_arrays(
            F.array(*[F.lit(c).cast(kind) for c, _ in found]),
            F.array(*[F.lit(rows / (len(found) * n)) for _, n in found]))
        return df.withColumn(name, F.try_element_at(known, quoted(target)))
    sums = counts.agg(F.struct(F.sum("__n").alias("n"), F.count(F.lit(1)).alias("k"))
                      .alias("s")).scalar()
    weights = counts.select(
        quoted(target), "__n",
        (sums.getField("n") / (sums.getField("k") * F.col("__n"))).alias(name))
    return lookup_join(df, weights, target, "__n")


def positive_weight(df: DataFrame, target: str, weight: float,
                    name: str = "class_weight") -> DataFrame:
    """Adds ``weight`` for rows of class 1 and 1 for the others."""
    return df.withColumn(name, F.when(quoted(target) == 1, F.lit(float(weight)))
                         .otherwise(F.lit(1.0)))


def balanced_weight(df: DataFrame, target: str, limit: int = 1000) -> Column:
    """The balanced class weight as an expression; needs one count per class."""
    counts = (df.filter(quoted(target).isNotNull()).groupBy(quoted(target).alias("c"))
              .agg(F.count(F.lit(1)).alias("n")).limit(limit + 1).collect())
    if len(counts) > limit:
        raise TooManyCategories(f"{target}: over {limit} classes")
    rows = sum(r["n"] for r in counts)
    weight = F.lit(1.0)
    for r in counts:
        weight = F.when(quoted(target) == r["c"],
                        F.lit(rows / (len(counts) * r["n"]))).otherwise(weight)
    return weight


def category_share_rows(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """(keys, value, n, share): how the rows of each key spread over the values of a column.

    Any number of values, one row each, so no key is gathered. A missing value is ``nan``, as in the
    names of dummies; rows with a missing key are dropped.
    """
    keys = [quoted(k) for k in by]
    present = df.dropna(subset=list(by))
    value = F.coalesce(_as_text(df, column), F.lit("nan"))
    counted = present.groupBy(*keys, value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*keys))
    return counted.withColumn("share", F.col("n") / total)


def category_shares(df: DataFrame, by: Sequence[str], column: str, name: str = "shares",
                    ) -> DataFrame:
    """One row per key with a map from value to share: the sparse form of all dummies' means.

    There is no limit on the number of values; a key holds those that it has. A value that a key
    lacks has share 0.
    """
    entries = F.array_sort(F.collect_list(F.struct("value", "share")))
    return category_share_rows(df, by, column).groupBy(*[quoted(k) for k in by]).agg(
        F.map_from_entries(entries).alias(name))


def share_of(shares: Column, value: str) -> Column:
    """Share of a value in a map of ``category_shares``, 0 where it does not occur."""
    return F.coalesce(F.try_element_at(shares, F.lit(value)), F.lit(0.0))
