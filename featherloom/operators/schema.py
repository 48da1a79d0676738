"""Column lists: by type, by presence, by name stem, and shared by two tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, types as T

from featherloom.naming import quoted


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def check_columns(df: DataFrame, columns: Iterable[str]) -> tuple[list[str], list[str]]:
    """(present, absent) in the given order."""
    have = set(df.columns)
    columns = list(columns)
    return [c for c in columns if c in have], [c for c in columns if c not in have]


def select_by_stem(df: DataFrame, stems: Sequence[str],
                   columns: Sequence[str] = ()) -> list[str]:
    """``columns`` plus every column whose name contains a stem, once each, sorted."""
    found = [c for c in df.columns if any(s in c for s in stems)]
    return sorted(set(columns) | set(found))


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


def sorted_columns(df: DataFrame) -> DataFrame:
    return df.select(*[quoted(c) for c in sorted(df.columns)])


def align_columns(train: DataFrame, test: DataFrame, target: str,
                  key: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Both tables cut to their common columns, sorted by name.

    The keys come first and the target last; the features between them are
    the sorted intersection.
    """
    common = set(train.columns) & set(test.columns)
    features = sorted(common - {target} - set(key))
    order = [*key, *features, target]
    return (train.select(*[quoted(c) for c in order if c in train.columns]),
            test.select(*[quoted(c) for c in order if c in test.columns]))


def cull_features(df: DataFrame, blacklist: Iterable[str]) -> DataFrame:
    """Drops the listed columns; an empty list changes nothing."""
    gone = set(blacklist)
    if not gone:
        return df
    return df.select(*[quoted(c) for c in df.columns if c not in gone])
