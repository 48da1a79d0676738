"""Built-in column expressions with missing-value rules of a data frame library.

A missing value is SQL NULL everywhere; NaN never stays in a column.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

# Largest finite numbers that replace an infinity.
MAX_DOUBLE = 1.7976931348623157e308
MAX_FLOAT = 3.4028234663852886e38
# Fixed value: magnitudes below this count as rounding noise in kurtosis.
KURTOSIS_FUZZ = 1e-14


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def widen(c: Column, dtype: T.DataType) -> Column:
    """Integer operand as long, so that ANSI arithmetic does not overflow early."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
        return c.cast("long")
    return c


def safe_divide(a: Column, b: Column) -> Column:
    """a/b with x/0 = +-inf and 0/0 = missing."""
    a, b = a.cast("double"), b.cast("double")
    at_zero = (F.when(a > 0, F.lit(float("inf")))
               .when(a < 0, F.lit(float("-inf"))))
    return nan_to_null(F.when(b == 0, at_zero).otherwise(a / b))


def positive_part(d: Column) -> Column:
    """max(d, 0); missing counts as 0."""
    return F.when(d > 0, d).otherwise(F.lit(0))


def total(terms: Sequence[Column]) -> Column:
    return functools.reduce(operator.add, terms) if terms else F.lit(0.0)


def product(terms: Sequence[Column]) -> Column:
    return functools.reduce(operator.mul, terms) if terms else F.lit(1.0)


def squared_sum(cols: Sequence[Column]) -> Column:
    """Sum of squares; missing terms count as 0."""
    return total([F.coalesce(c * c, F.lit(0)) for c in cols])


def finite(c: Column, dtype: T.DataType) -> Column:
    """missing -> 0, +-inf -> +-largest finite number of the type."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        top = MAX_FLOAT if isinstance(dtype, T.FloatType) else MAX_DOUBLE
        value = (F.when(c.isNull() | F.isnan(c), F.lit(0.0))
                 .when(c == F.lit(float("inf")), F.lit(top))
                 .when(c == F.lit(float("-inf")), F.lit(-top))
                 .otherwise(c))
        return value.cast(dtype)
    return F.coalesce(c, F.lit(0)).cast(dtype)


def key_digest(key: Column, seed: int) -> Column:
    """Reproducible pseudo-random order of rows: md5 of key and seed, also of a missing key."""
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f"|{seed}")))


def digest_number(digest: Column) -> Column:
    """First 8 hex digits of a digest as a long in [0, 2**32)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def unit_interval(digest: Column) -> Column:
    """Digest as a double in [0, 1)."""
    return digest_number(digest) / F.lit(4294967296.0)
