"""Two-column arithmetic, row statistics over column lists, pair products."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from featherloom.functions.columns import (
    KURTOSIS_FUZZ, finite, nan_to_null, positive_part, product, safe_divide,
    squared_sum, total, widen)
from featherloom.naming import pair_name, quoted, row_stat_name
from featherloom.operators.schema import check_columns
from featherloom.report import Report, ensure

ARITHMETIC: dict[str, Callable[[Column, Column], Column]] = {
    "add": lambda a, b: a + b,
    "subtract": lambda a, b: a - b,
    "subtract_positive": lambda a, b: positive_part(a - b),
    "multiply": lambda a, b: a * b,
    "divide": safe_divide,
    "divide_nonzero": lambda a, b: safe_divide(a, b.cast("double") + F.lit(1.0)),
    "sum_squared": lambda a, b: squared_sum([a, b]),
}
ROW_METHODS = ("kurtosis", "sum", "sum_squared", "product", "mean", "std")


def _no_nan(df: DataFrame, name: str) -> Column:
    """The named column with NaN (inf - inf, inf * 0) as missing."""
    floating = isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))
    return nan_to_null(quoted(name)) if floating else quoted(name)


def interaction(df: DataFrame, specs: Sequence[Mapping],
                report: Report | None = None) -> tuple[DataFrame, list[str]]:
    """Adds one column per ``{name, mode, a, b}``; later specs see earlier ones.

    An unknown mode or an absent column skips that spec.
    """
    report = ensure(report)
    created: list[str] = []
    for spec in specs:
        name, mode = spec["name"], spec.get("mode")
        if mode not in ARITHMETIC:
            report.skip("interaction", name, f"unknown mode {mode}")
            continue
        _, absent = check_columns(df, [spec["a"], spec["b"]])
        if absent:
            report.skip("interaction", name, f"absent columns {absent}")
            continue
        a, b = (widen(quoted(c), df.schema[c].dataType) for c in (spec["a"], spec["b"]))
        if mode == "subtract_positive":
            # inf - inf is missing, hence 0, before the comparison sees it
            difference = nan_to_null((a - b).cast("double"))
            df = df.withColumn(name, positive_part(difference).cast("double"))
        else:
            df = df.withColumn(name, ARITHMETIC[mode](a, b))
            df = df.withColumn(name, _no_nan(df, name))
        created.append(name)
    return df, created


def column_means(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Global means of the columns, all from one scalar subquery."""
    if not columns:
        return {}
    means = F.struct(*[F.avg(quoted(c).cast("double")).alias(f"m{i}")
                       for i, c in enumerate(columns)])
    fetched = df.agg(means.alias("means")).scalar()
    return {c: fetched.getField(f"m{i}") for i, c in enumerate(columns)}


def row_stats(df: DataFrame, spec: Mapping, report: Report | None = None) -> DataFrame:
    """Adds ``{header}_{METHOD}`` per method of ``{header, transform, columns}``."""
    return row_stats_list(df, [spec], report)


def row_stats_list(df: DataFrame, specs: Sequence[Mapping],
                   report: Report | None = None) -> DataFrame:
    """Row statistics of several specs; later specs may use columns of earlier ones.

    Specs that do not build on each other share their two passes over the
    table: one for the means that fill factors, one for those that fill stds.
    """
    report = ensure(report)
    batch: list[Mapping] = []
    made: set[str] = set()
    for spec in specs:
        if made & set(spec.get("columns", [])):
            df, batch, made = _row_stats_batch(df, batch, report), [], set()
        batch.append(spec)
        made |= {row_stat_name(spec.get("header", "NEW"), m) for m in spec.get("transform", [])}
    return _row_stats_batch(df, batch, report)


def _row_stats_batch(df: DataFrame, specs: Sequence[Mapping], report: Report) -> DataFrame:
    plans = []
    for spec in specs:
        header = spec.get("header", "NEW")
        present, absent = check_columns(df, spec.get("columns", []))
        for c in absent:
            report.skip("row_stats", c, f"absent column of {header}")
        methods = [m for m in spec.get("transform", []) if m in ROW_METHODS]
        for m in spec.get("transform", []):
            if m not in ROW_METHODS:
                report.skip("row_stats", m, f"unknown method of {header}")
        if present and methods:
            plans.append((header, present, methods))
    factors = dict.fromkeys(c for _, cols, ms in plans if "product" in ms for c in cols)
    means = column_means(df, list(factors))
    for header, present, methods in plans:
        df = _row_stats_of(df, header, present, methods, means)
    stds = [row_stat_name(h, "std") for h, _, ms in plans if "std" in ms]
    fills = column_means(df, stds)
    filled = {c: F.coalesce(quoted(c), fills[c]) for c in stds}
    return df.withColumns(filled) if filled else df


def _row_stats_of(df: DataFrame, header: str, present: Sequence[str], methods: Sequence[str],
                  means: Mapping[str, Column]) -> DataFrame:
    values = [nan_to_null(quoted(c).cast("double")) for c in present]
    # Shared moments sit in their own projections, so that each is computed once.
    tmp = {k: f"__{header}_{k}" for k in ("n", "sum", "mean", "m2", "m4")}
    if {"mean", "std", "kurtosis"} & set(methods):
        df = df.withColumns({
            tmp["n"]: total([F.when(v.isNotNull(), 1.0).otherwise(0.0) for v in values]),
            tmp["sum"]: total([F.coalesce(v, F.lit(0.0)) for v in values])})
        n = quoted(tmp["n"])
        df = df.withColumn(tmp["mean"], F.when(n > 0, quoted(tmp["sum"]) / n))
    if {"std", "kurtosis"} & set(methods):
        deviations = [v - quoted(tmp["mean"]) for v in values]
        moments = {tmp["m2"]: squared_sum(deviations)}
        if "kurtosis" in methods:
            moments[tmp["m4"]] = squared_sum([d * d for d in deviations])
        df = df.withColumns(moments)
    df = df.withColumns({
        row_stat_name(header, m): _row_expression(m, values, [means.get(c) for c in present], tmp)
        for m in methods})
    return df.drop(*tmp.values())


def _row_expression(method: str, values: Sequence[Column], means: Sequence[Column | None],
                    tmp: Mapping[str, str]) -> Column:
    if method == "sum":
        return nan_to_null(total([F.coalesce(v, F.lit(0.0)) for v in values]))
    if method == "sum_squared":
        return squared_sum(values)
    if method == "product":
        return nan_to_null(product([F.coalesce(v, m, F.lit(1.0))
                                    for v, m in zip(values, means)]))
    if method == "mean":
        return nan_to_null(quoted(tmp["mean"]))
    n, m2 = quoted(tmp["n"]), quoted(tmp["m2"])
    if method == "std":
        return nan_to_null(F.when(n > 1, F.sqrt(m2 / (n - 1))))
    # Bias-corrected excess kurtosis; a (nearly) constant row gives 0.
    numerator = n * (n + 1) * (n - 1) * quoted(tmp["m4"])
    denominator = (n - 2) * (n - 3) * m2 * m2
    correction = 3 * (n - 1) * (n - 1) / ((n - 2) * (n - 3))
    return nan_to_null(
        F.when(n > 3, F.when(F.abs(denominator) < KURTOSIS_FUZZ, F.lit(0.0))
               .otherwise(F.when(F.abs(numerator) < KURTOSIS_FUZZ, F.lit(0.0))
                          .otherwise(numerator) / denominator - correction)))


def pair_geometric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds sqrt(a*b) for every pair of columns, then fills missing values with 0.

    A missing factor counts as 1; a negative product gives 0.
    """
    types = {f.name: f.dataType for f in df.schema}
    made: dict[str, Column] = {}
    for a, b in combinations(columns, 2):
        root = (F.coalesce(nan_to_null(quoted(a).cast("double")), F.lit(1.0))
                * F.coalesce(nan_to_null(quoted(b).cast("double")), F.lit(1.0)))
        made[pair_name(a, b)] = finite(F.when(root >= 0, F.sqrt(root)), T.DoubleType())
    plain = [finite(quoted(c), types[c]).alias(c) if c in set(columns) else quoted(c)
             for c in df.columns]
    return df.select(*plain, *[v.alias(k) for k, v in made.items()])
