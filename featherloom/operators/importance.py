"""Feature importances over folds and files: totals, profile, blacklist."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from featherloom.ml.matrix import materialise
from featherloom.naming import quoted
from featherloom.operators.rank import exact_quantiles

# Quantiles of the profile and the default cut-off score.
PROFILE_QUANTILES = (0.1, 0.2, 0.25, 0.5, 0.75, 0.8, 0.9)
DEFAULT_THRESHOLD = 10.0


def importance_totals(df: DataFrame, feature: str = "feature",
                      importance: str = "importance") -> DataFrame:
    """Summed importance per feature."""
    return (df.filter(quoted(feature).isNotNull()).groupBy(quoted(feature))
            .agg(F.coalesce(F.sum(quoted(importance)), F.lit(0)).alias(importance)))


def importance_profile(totals: DataFrame, quantiles: Sequence[float] = PROFILE_QUANTILES,
                       importance: str = "importance") -> DataFrame:
    """One row: count, mean, std, min, quantiles (linear interpolation), max."""
    # the totals are few rows: written once, so their input is read once
    totals, x = materialise(totals), quoted(importance)
    names = [f"p{round(q * 100)}" for q in quantiles]
    spread = (exact_quantiles(totals, importance, quantiles, names=names)
              .select(F.struct(*names).alias("q")).scalar())
    moments = totals.agg(F.count(x).alias("count"), F.avg(x).alias("mean"),
                         F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
                         F.max(x).alias("max"))
    return moments.select("count", "mean", "std", "min",
                          *[spread.getField(n).alias(n) for n in names], "max")


def blacklist(totals: DataFrame, threshold: float = DEFAULT_THRESHOLD,
              importance: str = "importance") -> DataFrame:
    """Features whose total is at most the threshold."""
    return totals.filter(quoted(importance) <= F.lit(threshold))
