"""Helpers of the operators: tables, shared folder, partition counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from featherloom.ml.matrix import materialise
from featherloom.naming import quoted

__all__ = ["fresh", "group_task", "held_out", "materialise", "partitions", "table"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Names, one per stem, that no column of the table has."""
    have, out = {c.lower() for c in df.columns}, []
    for stem in stems:
        name = stem
        while name.lower() in have:
            name = "_" + name
        have.add(name.lower())
        out.append(name)
    return out


def group_task(df: DataFrame, key: str) -> DataFrame:
    """One row per key to as many tasks as the session shuffles to."""
    return df.repartition(partitions(df.sparkSession), quoted(key))


def held_out(doc_id: Column) -> Column:
    """True for the quarter of ids that no training may read; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))
