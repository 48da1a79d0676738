"""Exact ranking and probability metrics as group-by plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from featherloom.naming import quoted
from featherloom.operators.rank import prefix_sums, range_cuts

# Fixed value: distance of clipped probabilities from 0 and 1.
LOG_LOSS_CLIP = 2.220446049250313e-16


def class_ratio(df: DataFrame, target: str, name: str = "ratio") -> DataFrame:
    """Relative frequency per non-missing class."""
    counts = (df.filter(quoted(target).isNotNull()).groupBy(quoted(target))
              .agg(F.count(F.lit(1)).alias("n")))
    return counts.select(quoted(target),
                         (F.col("n") / counts.agg(F.sum("n").alias("n")).scalar()).alias(name))


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = (),
            name: str = "auc") -> DataFrame:
    """Exact area under the ROC curve with tied scores, one row per group.

    Scores are counted per class first; only distinct scores are ordered.
    A group without both classes gives NULL.
    """
    keys = [quoted(k) for k in by]
    value = quoted(score).cast("double")
    known = df.filter(value.isNotNull() & quoted(label).isNotNull()).withColumn("__s", value)
    counted = known.groupBy(*keys, "__s").agg(
        F.sum(F.when(quoted(label) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(quoted(label) == 1, 0).otherwise(1)).alias("neg"))
    placed = prefix_sums(counted, "__s", ["pos", "neg"], by, range_cuts(known, F.col("__s")))
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / F.lit(2.0)))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    area = F.when(pairs > 0, wins / pairs).alias(name)
    return placed.groupBy(*keys).agg(area) if by else placed.agg(area)


def log_loss(df: DataFrame, prob: str, label: str, by: Sequence[str] = (),
             name: str = "log_loss") -> DataFrame:
    """Mean negative log likelihood of clipped probabilities, one row per group."""
    p = F.least(F.greatest(quoted(prob).cast("double"), F.lit(LOG_LOSS_CLIP)),
                F.lit(1.0 - LOG_LOSS_CLIP))
    loss = F.avg(F.when(quoted(label) == 1, -F.log(p)).otherwise(-F.log(1.0 - p))).alias(name)
    known = df.filter(quoted(prob).isNotNull() & quoted(label).isNotNull())
    return known.groupBy(*[quoted(k) for k in by]).agg(loss) if by else known.agg(loss)
