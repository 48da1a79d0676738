"""Linear classifier with the modified Huber loss, by proximal Newton steps.

With y in (-1, 1) and z = y * margin, the loss is 0 for z >= 1, (1 - z)^2 for -1 <= z < 1 and -4z
below. Every pass over the rows is one aggregate: loss, gradient and curvature of all rows, summed
per task and then per cell, so that the driver holds one small square matrix and no rows. The step
minimises the quadratic model with the elastic-net penalty by coordinate descent; it is halved
until the objective falls.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from featherloom.naming import quoted

#: Coordinate descent on the quadratic model: sweeps, and change at which it ends.
SWEEPS, STILL = 1000, 1e-12
#: Most halvings of a step.
HALVINGS = 30


@dataclass
class HuberModel:
    """Weights, intercept last; objective of each pass that was accepted; optimality residual."""

    weights: np.ndarray
    objectives: list[float]
    residual: float

    def predict(self, df: DataFrame, features: str, name: str) -> DataFrame:
        """Adds P(class 1): the margin clipped to -1..1, from 0 to 1."""
        w = F.array(*[F.lit(float(v)) for v in self.weights[:-1]])
        margin = F.aggregate(F.zip_with(vector_to_array(quoted(features)), w, lambda a, b: a * b),
                             F.lit(float(self.weights[-1])), lambda a, v: a + v)
        return df.withColumn(name, (F.least(F.greatest(margin, F.lit(-1.0)), F.lit(1.0)) + 1) / 2)


def _sums(weights: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        d = len(weights)
        total = np.zeros(2 + d + d * d)
        for batch in batches:
            if not len(batch):
                continue
            x = np.column_stack([np.stack(batch["x"].to_numpy()), np.ones(len(batch))])
            y, share = 2.0 * batch["y"].to_numpy() - 1.0, batch["share"].to_numpy()
            z = y * (x @ weights)
            square, line = (z >= -1) & (z < 1), z < -1
            loss = np.where(square, (1 - z) ** 2, np.where(line, -4 * z, 0.0))
            slope = np.where(square, -2 * (1 - z), np.where(line, -4.0, 0.0)) * y
            total[0] += share.sum()
            total[1] += share @ loss
            total[2:2 + d] += x.T @ (share * slope)
            total[2 + d:] += (x.T @ (x * (2.0 * share * square)[:, None])).ravel()
        yield pd.DataFrame({"cell": np.arange(len(total)), "value": total})
    return run


def _pass(rows: DataFrame, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean loss, gradient and curvature of all rows at the weights."""
    d = len(weights)
    total = np.zeros(2 + d + d * d)
    for r in (rows.mapInPandas(_sums(weights), "cell int, value double").groupBy("cell")
              .agg(F.sum("value").alias("value")).collect()):
        total[r["cell"]] = r["value"]
    n = total[0] or 1.0
    return total[1] / n, total[2:2 + d] / n, total[2 + d:].reshape(d, d) / n


def _shrunk(v: float, by: float) -> float:
    return np.sign(v) * max(abs(v) - by, 0.0)


def _step(weights: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, l1: float, l2: float
          ) -> np.ndarray:
    """The weights that minimise the quadratic model with the penalty."""
    d = len(weights)
    ridge = np.append(np.full(d - 1, l2), 0.0)
    # a direction without curvature still gets a bounded step
    q = curvature + np.diag(ridge + 1e-9 + 1e-6 * np.trace(curvature) / d)
    slope = gradient + ridge * weights
    new = weights.copy()
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(d):
            pull = q[j, j] * new[j] - (slope[j] + q[j] @ (new - weights))
            value = (_shrunk(pull, l1) if j < d - 1 else pull) / q[j, j]
            moved = max(moved, abs(value - new[j]))
            new[j] = value
        if moved <= STILL * (1 + np.abs(new).max()):
            break
    return new


def optimality(weights: np.ndarray, gradient: np.ndarray, l1: float, l2: float) -> float:
    """Largest violation of the conditions of a minimum; the intercept carries no penalty."""
    w, g = weights[:-1], gradient[:-1] + l2 * weights[:-1]
    gap = np.where(w != 0, np.abs(g + l1 * np.sign(w)), np.maximum(np.abs(g) - l1, 0.0))
    return float(max(gap.max(initial=0.0), abs(gradient[-1])))


def fit_modified_huber(train: DataFrame, features: str, label: str, weight: str | None = None,
                       alpha: float = 1e-4, l1_ratio: float = 0.15, max_iter: int = 30,
                       tol: float = 1e-6) -> HuberModel:
    """Minimises mean loss + alpha * (l1_ratio * |w| + (1 - l1_ratio) / 2 * w^2).

    ``train`` should be a written table, as every pass reads it once. Rows without a label are left
    out; ``weight`` names a row weight. Ends after ``max_iter`` passes that lower the objective, or
    where the optimality conditions hold to ``tol``. Without rows all weights are 0.
    """
    rows = train.where(quoted(label).isNotNull()).select(
        vector_to_array(quoted(features)).alias("x"), quoted(label).cast("double").alias("y"),
        (quoted(weight).cast("double") if weight else F.lit(1.0)).alias("share"))
    first = rows.select(F.size("x").alias("n")).first()
    weights = np.zeros((first["n"] if first else 0) + 1)
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)

    def objective(w: np.ndarray, loss: float) -> float:
        return float(loss + l1 * np.abs(w[:-1]).sum() + l2 / 2 * (w[:-1] ** 2).sum())

    loss, gradient, curvature = _pass(rows, weights)
    found = [objective(weights, loss)]
    while len(found) <= max_iter and optimality(weights, gradient, l1, l2) > tol:
        whole, share = _step(weights, gradient, curvature, l1, l2), 1.0
        for _ in range(HALVINGS):
            tried = weights + share * (whole - weights)
            loss, next_gradient, next_curvature = _pass(rows, tried)
            if objective(tried, loss) < found[-1]:
                break
            share /= 2
        else:
            break
        weights, gradient, curvature = tried, next_gradient, next_curvature
        found.append(objective(weights, loss))
    return HuberModel(weights, found, optimality(weights, gradient, l1, l2))
