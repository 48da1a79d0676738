"""Feature vectors and materialised model inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F, types as T

from featherloom.functions.columns import finite
from featherloom.naming import quoted
from featherloom.sources.store import shared_folder


def dense(df: DataFrame, columns: Sequence[str]) -> Column:
    """The columns as one array<double>, missing values as 0."""
    types = {f.name: f.dataType for f in df.schema}
    return F.array(*[finite(quoted(c).cast("double"), T.DoubleType())
                     if not isinstance(types[c], T.BooleanType)
                     else F.coalesce(quoted(c).cast("double"), F.lit(0.0)) for c in columns])


def assemble(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    """Adds the feature vector of the columns."""
    return df.withColumn(name, array_to_vector(dense(df, columns)))


def materialise(df: DataFrame) -> DataFrame:
    """Writes a table to the shared folder once and reads it back.

    Cuts the lineage before many fits read the same rows; unlike a cache, the
    written table outlives lost executors.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
