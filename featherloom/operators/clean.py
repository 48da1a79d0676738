"""Row filters, value replacement, splits by target, and type narrowing."""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from featherloom.functions.columns import finite, nan_to_null
from featherloom.naming import quoted
from featherloom.operators.schema import check_columns
from featherloom.report import Report, ensure

# Range of a 32-bit integer.
INT32_MIN, INT32_MAX = -2147483648, 2147483647


def _missing(value: object) -> bool:
    return value is None or (isinstance(value, float) and math.isnan(value))


def normalise_missing(df: DataFrame) -> DataFrame:
    """NaN of every float column to NULL; done once after reading."""
    floats = (T.FloatType, T.DoubleType)
    return df.select(*[
        nan_to_null(quoted(f.name)).alias(f.name) if isinstance(f.dataType, floats)
        else quoted(f.name) for f in df.schema])


def drop_rows(df: DataFrame, rules: Mapping[str, Sequence],
              report: Report | None = None) -> DataFrame:
    """Removes rows in which any listed column holds a listed value.

    A missing value matches only when the list names it.
    """
    report = ensure(report)
    present, absent = check_columns(df, rules)
    for c in absent:
        report.skip("drop_rows", c, "absent column")
    hits: list[Column] = []
    for c in present:
        values = [v for v in rules[c] if not _missing(v)]
        if values:
            hits.append(F.coalesce(quoted(c).isin(values), F.lit(False)))
        if len(values) < len(rules[c]):
            hits.append(quoted(c).isNull())
    if not hits:
        return df
    return df.filter(~functools.reduce(operator.or_, hits))


def replace_values(df: DataFrame, rules: Mapping[str, Mapping],
                   report: Report | None = None) -> DataFrame:
    """Per-column value map; a None or NaN replacement means missing."""
    report = ensure(report)
    present, absent = check_columns(df, rules)
    for c in absent:
        report.skip("replace_values", c, "absent column")
    types = {f.name: f.dataType for f in df.schema}
    changed: dict[str, Column] = {}
    for c in present:
        source = quoted(c)
        keep = source.cast(types[c])
        branch = None
        for old, new in rules[c].items():
            hit = source.isNull() if _missing(old) else source == F.lit(old)
            value = F.lit(None if _missing(new) else new)
            branch = F.when(hit, value) if branch is None else branch.when(hit, value)
        if branch is not None:
            changed[c] = branch.otherwise(keep)
    return df.withColumns(changed) if changed else df


def subset(df: DataFrame, column: str, conditions: Sequence) -> DataFrame:
    """Rows whose column holds one of the values."""
    return df.filter(quoted(column).isin(list(conditions)))


def split_labelled(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a target, rows without)."""
    return df.filter(quoted(target).isNotNull()), df.filter(quoted(target).isNull())


def nan_to_num(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """missing -> 0 and +-inf -> +-largest number, in the numeric columns."""
    wanted = set(df.columns if columns is None else columns)
    return df.select(*[
        finite(quoted(f.name), f.dataType).alias(f.name)
        if f.name in wanted and isinstance(f.dataType, T.NumericType)
        else quoted(f.name) for f in df.schema])


def narrow_types(df: DataFrame, keep: Sequence[str] = (),
                 bounds: Mapping[str, tuple[int, int]] | None = None,
                 report: Report | None = None) -> DataFrame:
    """64-bit to 32-bit columns, ``keep`` exempt.

    Doubles become floats. A long becomes an int only where its values fit;
    the ranges come from ``bounds`` or, for columns it does not name, from one
    min/max aggregate. A column that does not fit stays 64 bit and is reported.
    """
    report = ensure(report)
    longs = [f.name for f in df.schema
             if isinstance(f.dataType, T.LongType) and f.name not in keep]
    known = dict(bounds or {})
    unknown = [c for c in longs if c not in known]
    if unknown:
        found = df.agg(*[F.min(quoted(c)).alias(f"lo{i}") for i, c in enumerate(unknown)],
                       *[F.max(quoted(c)).alias(f"hi{i}") for i, c in enumerate(unknown)]
                       ).first()
        known.update({c: (found[f"lo{i}"], found[f"hi{i}"])
                      for i, c in enumerate(unknown)})
    out = []
    for f in df.schema:
        c = quoted(f.name)
        if f.name in keep:
            out.append(c)
        elif isinstance(f.dataType, T.DoubleType):
            out.append(c.cast("float").alias(f.name))
        elif f.name in known and isinstance(f.dataType, T.LongType):
            lo, hi = known[f.name]
            if lo is None or (lo >= INT32_MIN and hi <= INT32_MAX):
                out.append(c.cast("int").alias(f.name))
            else:
                report.skip("narrow_types", f.name, "values exceed 32 bit")
                out.append(c)
        else:
            out.append(c)
    return df.select(*out)
