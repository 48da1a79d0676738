"""Feature reducers: components of a column group, added to each row."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import LDA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from featherloom.ml.matrix import dense, materialise
from featherloom.naming import component_name, quoted
from featherloom.operators.schema import check_columns, select_by_stem
from featherloom.report import Report, ensure

Reducer = Callable[[DataFrame, Sequence[str], str, Mapping], DataFrame]


def _with_components(df: DataFrame, name: str, values: Column, k: int) -> DataFrame:
    """Adds ``{name}_1`` .. ``{name}_k`` from an array column and drops temporaries."""
    df = df.withColumn("__y", values)
    df = df.withColumns({component_name(name, i + 1): F.col("__y")[i] for i in range(k)})
    return df.drop("__x", "__v", "__y", "__p")


def gram(df: DataFrame, column: str, width: int, shift: np.ndarray | None = None) -> DataFrame:
    """(i, j, value) for i <= j: sums of products of the entries of an array column, as one aggregate.

    Every task adds up its rows in one square matrix; ``shift`` is taken from each row first.
    """
    zero = np.zeros(width) if shift is None else np.asarray(shift, dtype=float)
    upper = np.triu_indices(width)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for batch in batches:
            if len(batch):
                x = np.stack(batch["x"].to_numpy()) - zero
                total += x.T @ x
        yield pd.DataFrame({"i": upper[0], "j": upper[1], "value": total[upper]})

    return (df.select(quoted(column).alias("x"))
            .mapInPandas(partial, "i int, j int, value double")
            .groupBy("i", "j").agg(F.sum("value").alias("value")))


def _principal_axes(df: DataFrame, width: int, k: int, shift: np.ndarray | None = None
                    ) -> np.ndarray:
    """d x k leading eigenvectors of the Gram matrix of ``__x``; the largest loading is positive."""
    whole = np.zeros((width, width))
    for r in gram(df, "__x", width, shift).collect():
        whole[r["i"], r["j"]] = whole[r["j"], r["i"]] = r["value"]
    axes = np.linalg.eigh(whole)[1][:, ::-1][:, :k]
    top = np.abs(axes).argmax(axis=0)
    return axes * np.sign(axes[top, range(axes.shape[1])])


def _project(df: DataFrame, name: str, axes: np.ndarray, shift: np.ndarray) -> DataFrame:
    """Components of the array column ``__x``: x . axes - shift, in Arrow batches."""
    k = axes.shape[1]

    @F.pandas_udf("array<double>")
    def apply(x: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack(x.to_numpy()) @ axes - shift))

    return _with_components(df, name, apply(F.col("__x")), k)


def truncated_svd(df: DataFrame, columns: Sequence[str], name: str, params: Mapping,
                  ) -> DataFrame:
    """Projection on the leading right singular vectors, without centring.

    They are the eigenvectors of the Gram matrix, which one pass over the rows adds up.
    """
    k = min(int(params.get("n_components", 2)), len(columns))
    df = df.withColumn("__x", dense(df, columns))
    axes = _principal_axes(df, len(columns), k)
    return _project(df, name, axes, np.zeros(k))


def pca(df: DataFrame, columns: Sequence[str], name: str, params: Mapping) -> DataFrame:
    """Projection of the centred columns on their principal axes: one pass for the means, one for
    the Gram matrix of the centred rows."""
    k = min(int(params.get("n_components", len(columns))), len(columns))
    df = df.withColumn("__x", dense(df, columns))
    means = df.agg(*[F.avg(F.col("__x")[i]) for i in range(len(columns))]).first()
    centre = np.nan_to_num(np.array(means, dtype=float))
    axes = _principal_axes(df, len(columns), k, centre)
    return _project(df, name, axes, centre @ axes)


def lda(df: DataFrame, columns: Sequence[str], name: str, params: Mapping) -> DataFrame:
    """Topic mixture of the columns; negative values count as 0.

    Fitted by EM, which passes over every row in each iteration; MLlib's online optimiser draws its
    rows with replacement even at a rate of 1. The priors are the uniform ones of 1/k, as EM counts.
    """
    k = int(params.get("n_components", 10))
    df = df.withColumn("__x", F.transform(dense(df, columns),
                                          lambda x: F.greatest(x, F.lit(0.0))))
    df = df.withColumn("__v", array_to_vector("__x"))
    model = LDA(k=k, maxIter=int(params.get("max_iter", 10)), featuresCol="__v", optimizer="em",
                docConcentration=[1 + 1 / k], topicConcentration=1 + 1 / k,
                seed=int(params.get("random_state", 42)), topicDistributionCol="__p").fit(df)
    # MLlib gives an empty row no topics; its mixture is the even prior
    empty = F.aggregate("__x", F.lit(0.0), lambda a, x: a + x) == 0
    mixture = F.when(empty, F.array_repeat(F.lit(1.0 / k), k)).otherwise(vector_to_array("__p"))
    return _with_components(model.transform(df), name, mixture, k)


def _row_mixture(x: np.ndarray, h: np.ndarray, steps: int) -> np.ndarray:
    """Non-negative weights of each row on the parts h, multiplicative updates."""
    w = np.maximum(x @ h.T, 1e-9)
    gram = h @ h.T
    target = x @ h.T
    for _ in range(steps):
        w *= target / np.maximum(w @ gram, 1e-12)
    return w


def nmf(df: DataFrame, columns: Sequence[str], name: str, params: Mapping) -> DataFrame:
    """Non-negative factors x ~ w . h; negative values count as 0.

    The parts h (components x columns) are small and travel with the tasks.
    The weights w are computed row by row; each pass over the written rows returns only the two
    small sums that update h. Ends after ``max_iter`` passes, or where no part changes by more than
    ``tol`` of the largest.
    """
    k, d = int(params.get("n_components", 2)), len(columns)
    steps = int(params.get("inner_iter", 20))
    seed = int(params.get("random_state", 42))
    df = df.withColumn("__x", F.transform(dense(df, columns),
                                          lambda x: F.greatest(x, F.lit(0.0))))
    rows, tol = materialise(df.select("__x")), float(params.get("tol", 1e-4))
    h = np.random.default_rng(seed).uniform(0.1, 1.0, (k, d))

    def sums(parts: np.ndarray) -> np.ndarray:
        mixture = _row_mixture

        def partial(batches):
            acc = np.zeros(k * (d + k))
            for pdf in batches:
                if len(pdf):
                    x = np.stack(pdf["__x"].to_numpy())
                    w = mixture(x, parts, steps)
                    acc += np.concatenate([(w.T @ x).ravel(), (w.T @ w).ravel()])
            yield pd.DataFrame({"i": np.arange(acc.size), "v": acc})

        out = (rows.mapInPandas(partial, "i int, v double").groupBy("i")
               .agg(F.sum("v").alias("v")).collect())
        flat = np.zeros(k * (d + k))
        for r in out:
            flat[r["i"]] = r["v"]
        return flat

    for _ in range(int(params.get("max_iter", 10))):
        flat = sums(h)
        wx, ww = flat[:k * d].reshape(k, d), flat[k * d:].reshape(k, k)
        before, h = h, h * wx / np.maximum(ww @ h, 1e-12)
        if np.abs(h - before).max() <= tol * np.abs(h).max():
            break

    mixture, parts = _row_mixture, h

    @F.pandas_udf("array<double>")
    def weights(x: pd.Series) -> pd.Series:
        return pd.Series(list(mixture(np.stack(x.to_numpy()), parts, steps)))

    return _with_components(df, name, weights(F.col("__x")), k)


def _random_projection(sparse: bool) -> Reducer:
    def reduce(df: DataFrame, columns: Sequence[str], name: str, params: Mapping) -> DataFrame:
        k, d = int(params.get("n_components", 2)), len(columns)
        rng = np.random.default_rng(int(params.get("random_state", 42)))
        if sparse:
            density = float(params.get("density", 1.0 / np.sqrt(d)))
            hit = rng.random((d, k)) < density
            sign = np.where(rng.random((d, k)) < 0.5, -1.0, 1.0)
            axes = hit * sign / np.sqrt(density * k)
        else:
            axes = rng.normal(0.0, 1.0 / np.sqrt(k), (d, k))
        return _project(df.withColumn("__x", dense(df, columns)), name, axes, np.zeros(k))

    return reduce


REDUCERS: dict[str, Reducer] = {
    "TruncatedSVD": truncated_svd,
    "PCA": pca,
    "IncrementalPCA": pca,
    "LatentDirichletAllocation": lda,
    "NMF": nmf,
    "GaussianRandomProjection": _random_projection(sparse=False),
    "SparseRandomProjection": _random_projection(sparse=True),
}


def decompose(df: DataFrame, spec: Mapping, report: Report | None = None,
              available: Sequence[str] | None = None) -> DataFrame:
    """Adds the components of ``{columns, stems, methods: {name: {object, params}}}``.

    ``available`` limits the stems to the columns that existed before, so that
    one group's components do not enter the next group.
    """
    report = ensure(report)
    base = df if available is None else df.select(*[quoted(c) for c in available])
    present, absent = check_columns(base, spec.get("columns", []))
    for c in absent:
        report.skip("decompose", c, "absent column")
    columns = select_by_stem(base, spec.get("stems", []), present)
    for name, method in spec.get("methods", {}).items():
        kind = method.get("object")
        if kind not in REDUCERS or not columns:
            report.skip("decompose", name, f"no reducer {kind} or no columns")
            continue
        df = REDUCERS[kind](df, columns, name, method.get("params", {}))
    return df
