"""Exact positions over a whole table without sorting it in one task.

Rows are cut into value ranges ("buckets"). Each bucket is ranked on its own
and shifted by the number of rows in the buckets below it. The cut points only
balance the work: any cuts give the same, exact ranks.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from featherloom.functions.columns import key_digest, nan_to_null
from featherloom.ml.matrix import materialise
from featherloom.naming import quoted
from featherloom.operators.joins import lookup_join

BUCKETS = 1024
# Sampled rows per bucket, for cut points of values that are not plain numbers.
SAMPLED = 32
# Leading hex digits of a digest that make a bucket: 4096 and 256 of them.
DIGEST_DIGITS = 3
HOT_DIGITS = 2


def ordered_number(df: DataFrame, column: str) -> Column:
    """The column as a plain value with the same order: times and truth values as numbers,
    strings, binaries and decimals as they are."""
    dtype = df.schema[column].dataType
    c = quoted(column)
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(dtype, T.BooleanType):
        return c.cast("int")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return nan_to_null(c.cast("double"))
    return c


def _constant(values: Sequence) -> Column:
    """Constant array of numbers or strings, sent as one literal."""
    if isinstance(values[0], str):
        return F.from_json(F.lit(json.dumps(list(values))), "array<string>")
    if isinstance(values[0], (bytes, bytearray)):
        return F.transform(F.split(F.lit(",".join(v.hex() for v in values)), ","), F.unhex)
    if isinstance(values[0], Decimal):
        scale = max(-v.as_tuple().exponent for v in values)
        return F.split(F.lit(",".join(format(v, "f") for v in values)), ",").cast(
            f"array<decimal(38,{max(0, scale)})>")
    kind = "double" if any(isinstance(v, float) for v in values) else "bigint"
    return F.split(F.lit(",".join(repr(v) for v in values)), ",").cast(f"array<{kind}>")


def range_cuts(df: DataFrame, value: Column, buckets: int = BUCKETS) -> list:
    """At most ``buckets - 1`` ascending cut points, repeats kept."""
    return range_cuts_of(df, [value], buckets)[0]


def range_cuts_of(df: DataFrame, values: Sequence[Column], buckets: int = BUCKETS) -> list[list]:
    """Cut points of several columns: quantile sketches of numbers, a sample of other types."""
    kinds = [f.dataType for f in df.select(*values).schema]
    plain = [isinstance(k, T.NumericType) and not isinstance(k, T.DecimalType) for k in kinds]
    numbers = _sketched_cuts(df, [v for v, p in zip(values, plain) if p], buckets)
    others = _sampled_cuts(df, [v for v, p in zip(values, plain) if not p], buckets)
    return [numbers.pop(0) if p else others.pop(0) for p in plain]


def _sampled_cuts(df: DataFrame, values: Sequence[Column], buckets: int) -> list[list]:
    """Cut points from about SAMPLED * buckets rows; a frequent value is repeated."""
    if not values:
        return []
    rows = df.count()
    share = min(1.0, SAMPLED * buckets / max(rows, 1))
    sample = df.select(*[v.alias(f"c{i}") for i, v in enumerate(values)]).sample(
        share, seed=1).collect()
    out = []
    for i in range(len(values)):
        found = sorted(r[i] for r in sample if r[i] is not None)
        out.append([found[len(found) * j // buckets] for j in range(1, buckets)]
                   if found else [])
    return out


def _sketched_cuts(df: DataFrame, values: Sequence[Column], buckets: int) -> list[list]:
    if not values:
        return []
    steps = _constant([i / buckets for i in range(1, buckets)])
    found = df.agg(*[F.percentile_approx(v, steps, 10000).alias(f"c{i}")
                     for i, v in enumerate(values)]).first()
    return [sorted(cuts) if cuts else [] for cuts in found]


def with_bucket(df: DataFrame, value: Column, cuts: Sequence, name: str) -> DataFrame:
    """Adds the number of distinct cuts below the value; missing values get 0.

    A binary search with one small projection per step stays in generated
    code; one expression over all cuts would be too long to be compiled.
    """
    points = sorted(set(cuts))
    df = df.withColumns({"__v": value, name: F.lit(0)})
    if points:
        table = _constant(points)
        step = 1 << (len(points).bit_length() - 1)
        while step:
            below = F.get(table, quoted(name) + F.lit(step - 1)) < F.col("__v")
            df = df.withColumn(name, quoted(name) + F.when(below, step).otherwise(0))
            step >>= 1
    return df.drop("__v")


def _shift(rows: DataFrame, shifts: DataFrame, by: Sequence[str],
           buckets: Sequence[str]) -> DataFrame:
    """Joins per-bucket values to the rows; a missing group is a group too."""
    renamed = {c: f"__k{i}" for i, c in enumerate([*by, *buckets])}
    shifts = shifts.withColumnsRenamed(renamed)
    match = F.lit(True)
    for c, k in renamed.items():
        match = match & (quoted(c).eqNullSafe(quoted(k)) if c in by
                         else quoted(c) == quoted(k))
    # without groups there is one row per bucket, a fixed bound
    return rows.join(shifts if by else F.broadcast(shifts), match).drop(*renamed.values())


def prefix_sums(counted: DataFrame, order: str, measures: Sequence[str],
                by: Sequence[str] = (), cuts: Sequence | None = None) -> DataFrame:
    """Adds ``{m}_before`` and ``{m}_total`` per measure, ordered by ``order``.

    ``counted`` holds one row per (by, order) pair. ``{m}_before`` sums the
    rows strictly below, ``{m}_total`` the whole ``by`` group.
    """
    by = list(by)
    keys = [quoted(k) for k in by]
    if cuts is None:
        cuts = range_cuts(counted, ordered_number(counted, order))
    bucketed = with_bucket(counted, ordered_number(counted, order), cuts, "__b")
    sizes = bucketed.groupBy(*keys, "__b").agg(
        *[F.sum(quoted(m)).alias(f"__s{i}") for i, m in enumerate(measures)])
    # one row per bucket: at most BUCKETS rows for each group
    below = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    shifts = sizes.select(
        *keys, "__b",
        *[F.coalesce(F.sum(f"__s{i}").over(below), F.lit(0)).alias(f"__o{i}")
          for i in range(len(measures))],
        *[F.sum(f"__s{i}").over(whole).alias(f"{m}_total") for i, m in enumerate(measures)])
    inside = (Window.partitionBy(*keys, "__b").orderBy(quoted(order))
              .rowsBetween(Window.unboundedPreceding, -1))
    ranked = bucketed.withColumns({
        f"__w{i}": F.coalesce(F.sum(quoted(m)).over(inside), F.lit(0))
        for i, m in enumerate(measures)})
    return _shift(ranked, shifts, by, ["__b"]).select(
        *[quoted(c) for c in counted.columns],
        *[(quoted(f"__w{i}") + quoted(f"__o{i}")).alias(f"{m}_before")
          for i, m in enumerate(measures)],
        *[quoted(f"{m}_total") for m in measures])


def value_positions(df: DataFrame, column: str, by: Sequence[str] = (),
                    cuts: Sequence | None = None) -> DataFrame:
    """Distinct values with ``n`` (ties), ``n_before`` and ``n_total``; NULLs left out.

    Counting comes first, so a value held by many rows is one row afterwards.
    """
    present = df.filter(ordered_number(df, column).isNotNull())
    counted = present.groupBy(*[quoted(k) for k in by], quoted(column)).agg(
        F.count(F.lit(1)).alias("n"))
    if cuts is None:
        cuts = range_cuts(present, ordered_number(df, column))
    return prefix_sums(counted, column, ["n"], by, cuts)


def tall_positions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column (its number), value, n, n_before, n_total of columns of one type, as written rows.

    ``df`` is read once, whatever the number of columns; missing values are left out.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("column"), quoted(c).alias("value"))
                      for i, c in enumerate(columns)])
    tall = df.select(F.explode(pairs).alias("pair")).select("pair.*")
    counted = materialise(tall.where(ordered_number(tall, "value").isNotNull())
                          .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    return materialise(prefix_sums(counted, "value", ["n"], by=["column"]))


def exact_quantiles(df: DataFrame, column: str, quantiles: Sequence[float],
                    by: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
    """Quantiles with linear interpolation, one row per group."""
    names = list(names or [f"q{i}" for i in range(len(quantiles))])
    positions = value_positions(df, column, by)
    value = quoted(column).cast("double")
    aggregates = []
    for q, name in zip(quantiles, names):
        place = (quoted("n_total") - 1) * F.lit(float(q))
        lower, upper = F.floor(place), F.ceil(place)

        def at(index: Column) -> Column:
            inside = (index >= quoted("n_before")) & (index < quoted("n_before") + quoted("n"))
            return F.max(F.when(inside, value))

        share = F.max(place - lower)
        low, high = at(lower), at(upper)
        # infinite neighbours have no difference
        aggregates.append(F.when(low == high, low)
                          .otherwise(nan_to_null(low + (high - low) * share)).alias(name))
    keys = [quoted(k) for k in by]
    return positions.groupBy(*keys).agg(*aggregates) if by else positions.agg(*aggregates)


def pct_rank(df: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """Percentile rank of each column over the whole table, average ties.

    Missing values stay missing and do not count. The ranks replace the column
    or, with a ``suffix``, go beside it.
    """
    names, ranked, kinds = df.columns, set(columns), {}
    for c in columns:
        kinds.setdefault(df.schema[c].dataType, []).append(c)
    # the columns of one type are counted and ranked together, as one tall table
    tables = [(same, tall_positions(df, same)) for same in kinds.values()]
    for same, positions in tables:
        rank = (F.col("n_before") + (F.col("n") + 1) / F.lit(2.0)) / F.col("n_total")
        for i, c in enumerate(same):
            table = positions.where(F.col("column") == i).select(
                F.col("value").alias(c), "n", "n_total", rank.alias(f"__pct_{c}"))
            df = lookup_join(df, table, c, "n", "n_total")
    kept = [quoted(f"__pct_{c}").alias(c) if c in ranked and not suffix else quoted(c)
            for c in names]
    beside = [quoted(f"__pct_{c}").alias(c + suffix) for c in columns] if suffix else []
    return df.select(*kept, *beside)


def digest_row_number(df: DataFrame, key: str, seed: int, name: str,
                      by: Sequence[str] = (), total: str | None = None,
                      source: DataFrame | None = None,
                      digits: int = DIGEST_DIGITS) -> DataFrame:
    """Row number (from 1) in a seeded pseudo-random order, per ``by`` group.

    Digests are even by nature, so their leading digits are the buckets.
    ``total`` names an optional column with the group size. ``source`` is the
    table the buckets are counted on, if ``df`` already has costly columns.
    """
    def with_digest(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("__d", key_digest(quoted(key), seed))
        return rows.withColumn("__b", F.substring("__d", 1, digits))

    counted = with_digest(df if source is None else source)
    return _number(with_digest(df), counted, ["__b"], ["__d", key], by, name, total)


def numbered_digests(df: DataFrame, digest: str, key: str, name: str, by: Sequence[str],
                     total: str | None = None, digits: int = DIGEST_DIGITS) -> DataFrame:
    """``digest_row_number`` for rows that carry their digests already; the digest column goes."""
    df = df.withColumn("__d", quoted(digest)).drop(digest)
    df = df.withColumn("__b", F.substring("__d", 1, digits))
    return _number(df, df, ["__b"], ["__d", key], by, name, total)


def ordered_row_number(df: DataFrame, order_by: str, key: str, name: str,
                       seed: int = 0, by: Sequence[str] = (),
                       total: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Row number (from 1) by ``order_by``, ties in seeded digest order of the key.

    Missing values come first. A value that fills more than one bucket gets
    buckets of its own, split by the digest, so that one frequent value does
    not end up in one task.
    """
    value = ordered_number(df, order_by)
    cuts = range_cuts(df, value, buckets)
    hot = sorted(c for c, times in Counter(cuts).items() if times > 1)
    is_hot = value.isNull() | (value.isin(hot) if hot else F.lit(False))
    df = df.withColumn("__d", key_digest(quoted(key), seed))
    df = with_bucket(df, value, cuts, "__b").withColumns({
        "__b": F.when(value.isNull(), -1).otherwise(F.col("__b")),
        "__h": F.when(is_hot, F.substring("__d", 1, HOT_DIGITS)).otherwise(""),
    })
    return _number(df, df, ["__b", "__h"], [order_by, "__d", key], by, name, total)


def _number(df: DataFrame, counted: DataFrame, buckets: Sequence[str],
            order: Sequence[str], by: Sequence[str], name: str,
            total: str | None) -> DataFrame:
    by = list(by)
    keys = [quoted(k) for k in by]
    sizes = counted.groupBy(*keys, *buckets).agg(F.count(F.lit(1)).alias("__n"))
    below = (Window.partitionBy(*keys).orderBy(*buckets)
             .rowsBetween(Window.unboundedPreceding, -1))
    shifts = sizes.select(*keys, *buckets,
                          F.coalesce(F.sum("__n").over(below), F.lit(0)).alias("__o"),
                          F.sum("__n").over(Window.partitionBy(*keys)).alias("__size"))
    inside = Window.partitionBy(*keys, *buckets).orderBy(*[quoted(c) for c in order])
    df = df.withColumn("__r", F.row_number().over(inside))
    df = _shift(df, shifts, by, buckets).withColumn(name, quoted("__r") + quoted("__o"))
    if total:
        df = df.withColumn(total, quoted("__size"))
    return df.drop("__d", "__r", "__o", "__size", *buckets)


def running_best(df: DataFrame, score: str, order_by: str, name: str,
                 by: Sequence[str] = ()) -> DataFrame:
    """Running maximum of ``score`` by ``order_by`` within each ``by`` group.

    Rows of equal order are one step: each sees the best of them all. They are reduced to one row
    before anything is ordered, so a frequent order value, or a missing one, which comes first, is
    no task's burden; the maxima of buckets and of the steps in them make up the rest.
    """
    step = _step_of(df, [*by, order_by])
    rows = df.withColumn("__step", step)
    steps = materialise(rows.groupBy("__step").agg(
        F.max(quoted(score)).alias("__best"), F.count(F.lit(1)).alias("__n")))
    keys = [f"__by{i}" for i in range(len(by))]
    steps = steps.select("*", *[F.col("__step")[f"c{i}"].alias(k) for i, k in enumerate(keys)],
                         F.col("__step")[f"c{len(by)}"].alias("__order"))
    steps = with_bucket(steps, F.col("__order"), range_cuts(steps, F.col("__order")), "__b")
    below = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    tops = steps.groupBy(*keys, "__b").agg(F.max("__best").alias("__top")).select(
        *keys, "__b", F.max("__top").over(below).alias("__low"))
    inside = (Window.partitionBy(*keys, "__b").orderBy("__order")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = _shift(steps.withColumn("__run", F.max("__best").over(inside)), tops, keys, ["__b"])
    table = found.select("__step", "__n", F.greatest("__run", "__low").alias("__out"))
    return (lookup_join(rows, table, "__step", "__n").drop("__step")
            .withColumn(name, F.col("__out")).drop("__out"))


def _step_of(df: DataFrame, columns: Sequence[str]) -> Column:
    """The columns as one never-missing value to group and join by; the last one as its order."""
    last = len(columns) - 1
    return F.struct(*[(ordered_number(df, c) if i == last else quoted(c)).alias(f"c{i}")
                      for i, c in enumerate(columns)])
