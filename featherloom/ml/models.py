"""Named classifiers on MLlib behind one fit/predict shape, and out-of-fold fitting."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier)
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from featherloom.functions.columns import key_digest, unit_interval
from featherloom.ml.ensembles import (
    boost_with_patience, fit_extra_trees, fit_forest, poisson_count as _poisson_count)
from featherloom.ml.huber import fit_modified_huber
from featherloom.ml.matrix import materialise
from featherloom.naming import quoted
from featherloom.operators.encode import balanced_weight
from featherloom.operators.joins import union_rows
from featherloom.operators.metrics import log_loss, roc_auc
from featherloom.parallel import run_parallel
from featherloom.report import Report, ensure

# Class names a spec may use -> kind of learner.
KINDS = {
    "XGBClassifier": "boosted_trees", "LGBMClassifier": "boosted_trees",
    "RandomForestClassifier": "random_forest", "ExtraTreesClassifier": "extra_trees",
    "SGDClassifier": "elastic_net", "GaussianNB": "gaussian_nb",
    "KNeighborsClassifier": "knn", "BaggingClassifier": "bagging",
}

# Spec parameter -> MLlib parameter and conversion, per kind.
_TREES = {
    "max_depth": ("maxDepth", int), "max_bins": ("maxBins", int),
    "min_samples_leaf": ("minInstancesPerNode", int),
    "min_child_samples": ("minInstancesPerNode", int),
    "random_state": ("seed", int), "seed": ("seed", int),
}
PARAMETERS = {
    "boosted_trees": {
        **_TREES, "n_estimators": ("maxIter", int), "learning_rate": ("stepSize", float),
        "subsample": ("subsamplingRate", float),
        "colsample_bytree": ("featureSubsetStrategy", str),
        "min_split_gain": ("minInfoGain", float), "gamma": ("minInfoGain", float),
        "validation_tol": ("validationTol", float),
    },
    "random_forest": {
        **_TREES, "n_estimators": ("numTrees", int), "criterion": ("impurity", str),
        "max_features": ("featureSubsetStrategy", str),
        "max_samples": ("subsamplingRate", float),
    },
    "elastic_net": {
        "l1_ratio": ("elasticNetParam", float), "alpha": ("regParam", float),
        "max_iter": ("maxIter", int), "tol": ("tol", float),
    },
    "gaussian_nb": {},
}
PARAMETERS["extra_trees"] = PARAMETERS["random_forest"]
# Parameters that say how to run, not what to fit; dropping them changes nothing.
SILENT = frozenset({"n_jobs", "verbosity", "verbose", "verbose_eval", "device", "metric",
                    "eval_metric", "metric_freq", "objective", "tree_method", "nthread"})
# Parameters that the code below reads itself, and values of others that change nothing.
HANDLED = {
    "boosted_trees": frozenset({"early_stopping_rounds"}),
    "random_forest": frozenset({"oob_score"}),
}
NEUTRAL = {"loss": ("log", "log_loss", "modified_huber"), "booster": ("gbtree", "gblinear"),
           "boosting_type": ("gbdt",), "penalty": ("elasticnet", "l1", "l2")}
# MLlib's own limit on the depth of a tree.
MAX_DEPTH = 30


@dataclass
class Fitted:
    """A fitted classifier: ``predict(df, name)`` adds P(class 1)."""

    predict: Callable[[DataFrame, str], DataFrame]
    importances: Sequence[float] | None = None
    iterations: int | None = None
    #: Held-out loss of every round that early stopping looked at.
    losses: Sequence[float] | None = None
    #: Adds to the training rows the mean vote ``name`` of the ``<name>_trees`` that did not draw
    #: them, if the model keeps its bags.
    out_of_bag: Callable[[DataFrame, str], DataFrame] | None = None


def kind_of(model: str, params: Mapping) -> str:
    if model in KINDS and params.get("booster") == "gblinear":
        return "elastic_net"
    return KINDS.get(model, model)


def _translate(kind: str, params: Mapping, report: Report) -> dict:
    out: dict = {}
    if "reg_lambda" in params and kind == "elastic_net":
        # a linear booster gives its L1 and L2 penalties apart
        l1, l2 = float(params.get("reg_alpha", 0.0)), float(params["reg_lambda"])
        out.update(regParam=l1 + l2, elasticNetParam=l1 / (l1 + l2) if l1 + l2 else 0.0)
    if kind == "elastic_net" and params.get("penalty") in ("l1", "l2"):
        out["elasticNetParam"] = float(params["penalty"] == "l1")
    for name, value in params.items():
        target = PARAMETERS[kind].get(name)
        if name in HANDLED.get(kind, ()) or value in NEUTRAL.get(name, ()):
            continue
        if name == "l1_ratio" and "elasticNetParam" in out:
            continue    # the penalty has settled it
        if target and target[0] == "maxDepth":
            out["maxDepth"] = _depth(kind, value, report)
        elif target:
            out[target[0]] = target[1](value)
        elif name not in SILENT and name not in ("scale_pos_weight", "class_weight") and not (
                out and name in ("reg_alpha", "reg_lambda") and kind == "elastic_net"):
            report.skip("fit", f"{kind}.{name}", "no equivalent in MLlib")
    return out


def _depth(kind: str, value: object, report: Report) -> int:
    """Tree depth; None and -1 mean no limit, which MLlib has only up to MAX_DEPTH."""
    if value is None or int(value) < 0 or int(value) > MAX_DEPTH:
        report.skip("fit", f"{kind}.max_depth", f"{value} becomes MLlib's limit {MAX_DEPTH}")
        return MAX_DEPTH
    return int(value)


def _estimator(kind: str, params: Mapping, report: Report):
    args = _translate(kind, params, report)
    if kind == "boosted_trees":
        return GBTClassifier(**args)
    if kind == "random_forest":
        return RandomForestClassifier(**args)
    if kind == "extra_trees":
        # all rows for every tree
        return RandomForestClassifier(**{"bootstrap": False, "featureSubsetStrategy": "sqrt",
                                         **args})
    if kind == "elastic_net":
        return LogisticRegression(**{"elasticNetParam": 0.15, "regParam": 0.0001,
                                     "standardization": False, **args})
    if kind == "gaussian_nb":
        return NaiveBayes(modelType="gaussian")
    raise ValueError(f"unknown classifier: {kind}")


def _weighted(train: DataFrame, params: Mapping, label: str, weight: str | None,
              ) -> tuple[DataFrame, str | None]:
    """Class weights of the spec, times a given row weight."""
    parts = [quoted(weight)] if weight else []
    if params.get("class_weight") == "balanced":
        parts.append(balanced_weight(train, label))
    if float(params.get("scale_pos_weight", 1.0)) != 1.0:
        parts.append(F.when(quoted(label) == 1, F.lit(float(params["scale_pos_weight"])))
                     .otherwise(1.0))
    if not parts:
        return train, None
    value = parts[0]
    for p in parts[1:]:
        value = value * p
    return train.withColumn("__weight", value), "__weight"


def fit(model: str, params: Mapping, train: DataFrame, label: str = "label",
        features: str = "features", key: str = "key", weight: str | None = None,
        validation: str | None = None, report: Report | None = None) -> Fitted:
    """Fits a named classifier on a table with key, label and feature vector.

    ``validation`` names a boolean column of held-out rows that stop a boosted
    model early. With ``early_stopping_rounds`` it keeps the round of least loss that so many rounds
    without gain follow, of at most ``n_estimators``; otherwise training ends when their loss no
    longer improves by the tolerance. A forest with ``oob_score`` keeps each tree's bag. Extra
    trees split at random thresholds. The ``modified_huber`` loss has its own solver.
    """
    report = ensure(report)
    kind = kind_of(model, params)
    if kind == "knn":
        from featherloom.ml.neighbours import fit_knn
        return fit_knn(train, params, key, features, label)
    if kind == "bagging":
        return _fit_bagging(params, train, label, features, key, report)
    train, weight_col = _weighted(train, params, label, weight)
    if kind == "elastic_net" and params.get("loss") == "modified_huber":
        args = _translate(kind, params, report)
        linear = fit_modified_huber(
            materialise(train), features, label, weight_col, args.get("regParam", 0.0001),
            args.get("elasticNetParam", 0.15), args.get("maxIter", 30), args.get("tol", 1e-6))
        return Fitted(lambda df, name: linear.predict(df, features, name),
                      losses=linear.objectives)
    estimator = _estimator(kind, params, report)
    estimator.setFeaturesCol(features).setLabelCol(label)
    if weight_col:
        estimator.setWeightCol(weight_col)
    iterations = losses = out_of_bag = None
    if kind == "extra_trees":
        predict, importances = fit_extra_trees(
            estimator, train, features, weight_col, int(params.get("parallelism", 4)))
        return Fitted(predict, importances)
    if validation and kind == "boosted_trees" and params.get("early_stopping_rounds"):
        fitted, iterations, losses = boost_with_patience(
            estimator, train.filter(~quoted(validation)), train.filter(quoted(validation)),
            int(params["early_stopping_rounds"]))
    elif kind == "random_forest" and params.get("oob_score"):
        fitted, out_of_bag = fit_forest(estimator, train, key, weight_col,
                                        int(params.get("parallelism", 4)))
    else:
        if validation and kind == "boosted_trees":
            estimator.setValidationIndicatorCol(validation)
        fitted = estimator.fit(train)
        iterations = fitted.getNumTrees if kind == "boosted_trees" else None

    def predict(df: DataFrame, name: str) -> DataFrame:
        raw, vec, hard = f"__raw_{name}", f"__prob_{name}", f"__hard_{name}"
        # own column names, so that several models can score the same row
        scored = (fitted.copy({fitted.rawPredictionCol: raw, fitted.probabilityCol: vec,
                               fitted.predictionCol: hard}).transform(df))
        return scored.withColumn(name, vector_to_array(vec)[1]).drop(raw, vec, hard)

    importances = getattr(fitted, "featureImportances", None)
    return Fitted(predict, None if importances is None else importances.toArray().tolist(),
                  iterations, losses, out_of_bag)


def _fit_bagging(params: Mapping, train: DataFrame, label: str, features: str, key: str,
                 report: Report) -> Fitted:
    """Mean probability of copies of a base model on row and column samples.

    A bootstrap draws each row a Poisson number of times, as a row weight, so
    that no task needs to see the whole table.
    """
    base = params.get("base_estimator") or {"model": "random_forest", "params": {}}
    bags = int(params.get("n_estimators", 10))
    share = float(params.get("max_samples", 1.0))
    seed = int(params.get("random_state", 42))
    width = int(train.select(F.size(vector_to_array(quoted(features)))).first()[0])
    take = max(1, int(round(width * float(params.get("max_features", 1.0)))))

    def one(i: int) -> Callable[[], tuple[VectorSlicer, Fitted]]:
        def run() -> tuple[VectorSlicer, Fitted]:
            rng = np.random.default_rng(seed + i)
            chosen = sorted(int(c) for c in rng.choice(width, take, replace=False))
            slicer = VectorSlicer(inputCol=features, outputCol=f"__bag{i}", indices=chosen)
            u = unit_interval(key_digest(quoted(key), seed + i))
            if params.get("bootstrap", True):
                sample = train.withColumn("__times", _poisson_count(u, share).cast("double"))
                sample, weight = sample.filter("__times > 0"), "__times"
            else:
                sample, weight = train.filter(u < F.lit(share)), None
            return slicer, fit(base["model"], base.get("params", {}), slicer.transform(sample),
                               label, f"__bag{i}", key, weight, report=report)
        return run

    members = run_parallel([one(i) for i in range(bags)], int(params.get("parallelism", 4)))

    def predict(df: DataFrame, name: str) -> DataFrame:
        names = [f"__{name}_{i}" for i in range(bags)]
        for (slicer, member), n in zip(members, names):
            df = member.predict(slicer.transform(df), n).drop(slicer.getOutputCol())
        mean = sum((quoted(n) for n in names), F.lit(0.0)) / F.lit(float(bags))
        return df.withColumn(name, mean).drop(*names)

    return Fitted(predict)


@dataclass
class OutOfFold:
    """Tables of one cross-validated run."""

    train_oof: DataFrame
    test_oof: DataFrame | None
    importances: DataFrame | None
    iterations: list[int]
    test_full: DataFrame | None = None
    #: fold, round, loss, kept: the held-out loss of each round and the round that stays.
    loss_curves: DataFrame | None = None

    def bundle(self) -> dict[str, DataFrame]:
        tables = {"train_oof": self.train_oof, "test_oof": self.test_oof,
                  "test_full": self.test_full, "feature_importance": self.importances}
        return {n: t for n, t in tables.items() if t is not None}


def oof_predict(train: DataFrame, model: str, params: Mapping, n_folds: int,
                test: DataFrame | None = None, key: str = "key", label: str = "label",
                features: str = "features", fold: str = "fold",
                feature_names: Sequence[str] | None = None, early_stopping: bool = False,
                parallelism: int = 4, report: Report | None = None) -> OutOfFold:
    """Per fold: fit on the other rows, predict the held-out ones.

    ``train`` carries a fold column. The test prediction is the mean over the
    fold models, computed side by side in one pass without a shuffle.
    """
    report = ensure(report)

    def one(i: int) -> Callable[[], Fitted]:
        def run() -> Fitted:
            if early_stopping:
                rows = train.withColumn("__valid", quoted(fold) == i)
                return fit(model, params, rows, label, features, key, validation="__valid",
                           report=report)
            return fit(model, params, train.filter(quoted(fold) != i), label, features, key,
                       report=report)
        return run

    fitted = run_parallel([one(i) for i in range(n_folds)], parallelism)
    held = [f.predict(train.filter(quoted(fold) == i), "proba")
            .select(quoted(key), quoted(label), quoted(fold), "proba")
            for i, f in enumerate(fitted)]
    test_oof = None
    if test is not None:
        names = [f"__p{i}" for i in range(n_folds)]
        scored = test
        for f, n in zip(fitted, names):
            scored = f.predict(scored, n)
        mean = sum((quoted(n) for n in names), F.lit(0.0)) / F.lit(float(n_folds))
        test_oof = scored.select(quoted(key), mean.alias("proba"))
    return OutOfFold(union_rows(held), test_oof,
                     _importance_table(train, fitted, feature_names),
                     [f.iterations for f in fitted if f.iterations is not None],
                     loss_curves=_loss_curves(train, fitted))


def _loss_curves(train: DataFrame, fitted: Sequence[Fitted]) -> DataFrame | None:
    rows = [(i, n, float(loss), n == f.iterations) for i, f in enumerate(fitted)
            if f.iterations is not None for n, loss in enumerate(f.losses or (), 1)]
    if not rows:
        return None
    return train.sparkSession.createDataFrame(
        rows, "fold int, round int, loss double, kept boolean")


def _importance_table(train: DataFrame, fitted: Sequence[Fitted],
                      names: Sequence[str] | None) -> DataFrame | None:
    rows = [(names[j] if names else f"f{j}", float(v), i + 1)
            for i, f in enumerate(fitted) for j, v in enumerate(f.importances or [])]
    if not rows:
        return None
    return train.sparkSession.createDataFrame(
        rows, "feature string, importance double, fold int")


def refit_full(train: DataFrame, test: DataFrame, model: str, params: Mapping,
               iterations: Sequence[int], key: str = "key", label: str = "label",
               features: str = "features", report: Report | None = None) -> DataFrame:
    """Refits on all rows with the largest best iteration and predicts the test rows."""
    settings = dict(params)
    if iterations:
        settings["n_estimators"] = max(iterations)
    fitted = fit(model, settings, train, label, features, key, report=report)
    return fitted.predict(test, "proba").select(quoted(key), "proba")


METRICS: dict[str, tuple[Callable[..., DataFrame], float]] = {
    "roc_auc": (roc_auc, 1.0),
    "neg_log_loss": (log_loss, -1.0),
}


def cross_val_scores(oof: DataFrame, metric: str = "neg_log_loss", label: str = "label",
                     fold: str = "fold") -> DataFrame:
    """Score per fold; larger is better for every metric."""
    function, sign = METRICS[metric]
    scored = function(oof, "proba", label, by=[fold], name="score")
    return scored.withColumn("score", F.col("score") * F.lit(sign))


def nb_class_stats(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Prior and, per feature, mean and population variance of every class."""
    aggregates = [F.count(F.lit(1)).alias("n")]
    for c in columns:
        aggregates += [F.avg(quoted(c)).alias(f"{c}_mean"),
                       F.var_pop(quoted(c)).alias(f"{c}_var")]
    counts = df.filter(quoted(label).isNotNull()).groupBy(quoted(label)).agg(*aggregates)
    rows = df.filter(quoted(label).isNotNull()).agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("prior", F.col("n") / rows)
