"""Aggregate functions a spec may name, with an optional row condition."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F, types as T

from featherloom.functions.columns import nan_to_null


def _floating(c: Column, dtype: T.DataType) -> Column:
    return nan_to_null(c) if isinstance(dtype, (T.FloatType, T.DoubleType)) else c


def _sum(c: Column, dtype: T.DataType) -> Column:
    return F.coalesce(_floating(F.sum(c), dtype), F.lit(0))


# name -> f(value column, value type). Conditions arrive as NULLed-out values.
FUNCTIONS: dict[str, Callable[[Column, T.DataType], Column]] = {
    "min": lambda c, t: F.min(c),
    "max": lambda c, t: F.max(c),
    "mean": lambda c, t: nan_to_null(F.avg(c)),
    "sum": _sum,
    "var": lambda c, t: nan_to_null(F.var_samp(c)),
    "std": lambda c, t: nan_to_null(F.stddev_samp(c)),
    "count": lambda c, t: F.count(c),
    "nunique": lambda c, t: F.count_distinct(c),
}
# "size" counts rows rather than values; "median" needs the ordered positions.
ROW_COUNT = "size"
ORDERED = "median"
KNOWN = frozenset(FUNCTIONS) | {ROW_COUNT, ORDERED}

# Functions that are 0, not missing, when the values are all missing.
ZERO_WHEN_EMPTY = frozenset({"sum", "count", "nunique", ROW_COUNT})


def expression(function: str, column: Column, dtype: T.DataType,
               condition: Column | None = None) -> Column:
    """Aggregate expression of one value column under an optional condition."""
    if function == ROW_COUNT:
        one = F.lit(1)
        return F.count(one if condition is None else F.when(condition, one))
    if function not in FUNCTIONS:
        raise ValueError(f"unknown aggregate function: {function}")
    if isinstance(dtype, T.BooleanType):
        column, dtype = column.cast("int"), T.IntegerType()
    value = column if condition is None else F.when(condition, column)
    return FUNCTIONS[function](value, dtype)
