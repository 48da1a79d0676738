"""First rows, best trial per task, means over repeated runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from featherloom.naming import quoted


def head(df: DataFrame, n: int, order_by: str | Sequence[str]) -> DataFrame:
    """The first n rows by ``order_by``."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*[quoted(c) for c in order]).limit(n)


def best_trial(trials: DataFrame, task: str = "task", score: str = "score",
               trial: str = "trial") -> DataFrame:
    """The row with the highest score per task; the earliest trial wins ties."""
    whole = F.struct(*[quoted(c) for c in trials.columns])
    order = F.struct(quoted(score), -quoted(trial))
    best = (trials.filter(quoted(score).isNotNull()).groupBy(quoted(task))
            .agg(F.max_by(whole, order).alias("b")))
    return best.select(*[F.col("b").getField(c).alias(c) for c in trials.columns])


def mean_by_key(runs: DataFrame, key: str, value: str = "proba") -> DataFrame:
    """Average of the value per key over stacked runs."""
    return runs.groupBy(quoted(key)).agg(F.avg(quoted(value)).alias(value))
