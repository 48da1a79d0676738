"""Collects queries and their SQL by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from featherloom.naming import quoted

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Rounds double columns: sums of doubles differ in the last bits by order."""
    def cell(f: T.StructField) -> Column:
        c = quoted(f.name)
        return F.round(c, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else c
    return df.select(*[cell(f) for f in df.schema])


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    """Counts that a left join can leave missing, as doubles."""
    return df.withColumns({c: quoted(c).cast("double") for c in columns})
