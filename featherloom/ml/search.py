"""Hyper-parameter search: trials are rows, scores come from cross-validated fits."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from featherloom.functions.columns import unit_interval
from featherloom.ml.matrix import materialise
from featherloom.ml.models import cross_val_scores, oof_predict
from featherloom.naming import quoted
from featherloom.operators.joins import union_rows
from featherloom.operators.rank import running_best
from featherloom.operators.splits import (
    kfold, shuffle_split, stratified_kfold, stratified_shuffle_split, time_series_split)
from featherloom.operators.topk import best_trial
from featherloom.parallel import run_parallel
from featherloom.report import Report, ensure
from featherloom.sources.store import save_params


def real(low: float, high: float, prior: str = "uniform") -> dict:
    return {"type": "real", "low": low, "high": high, "prior": prior}


def integer(low: int, high: int) -> dict:
    return {"type": "integer", "low": low, "high": high}


def drawn(name: str, space: Mapping, trial: Column, seed: int) -> Column:
    """Value of one parameter in a trial, from a seeded digest of both."""
    u = unit_interval(F.md5(F.concat(F.lit(f"{name}|"), trial.cast("string"),
                                     F.lit(f"|{seed}"))))
    low, high = space["low"], space["high"]
    if space["type"] == "integer":
        return (F.lit(int(low)) + F.floor(u * (int(high) - int(low) + 1))).cast("int")
    if space.get("prior") == "log-uniform":
        return F.lit(float(low)) * F.exp(u * math.log(high / low))
    return F.lit(float(low)) + u * float(high - low)


def sample_trials(trials: DataFrame, space: Mapping[str, Mapping], seed: int = 42,
                  trial: str = "trial") -> DataFrame:
    """Adds one column per parameter to a table of trial numbers."""
    return trials.withColumns({name: drawn(name, space[name], quoted(trial), seed)
                               for name in sorted(space)})


def best_so_far(trials: DataFrame, task: str = "task", trial: str = "trial",
                score: str = "score", name: str = "best_score") -> DataFrame:
    """Adds the running best score of each task."""
    return running_best(trials, score, trial, name, by=[task])


def _with_fold(train: DataFrame, settings: Mapping, key: str, label: str,
               ) -> list[tuple[DataFrame, int]]:
    """(table with a fold column, number of folds) per repetition of the split."""
    kind = settings.get("validation", "KFold")
    k, seed = int(settings.get("nr_fold", 3)), int(settings.get("split_seed", 42))
    if kind == "KFold":
        return [(kfold(train, key, k, seed), k)]
    if kind == "StratifiedKFold":
        return [(stratified_kfold(train, key, label, k, seed), k)]
    if kind == "TimeSeriesSplit":
        blocks = time_series_split(train, key, settings.get("order_by", key), k, "block")
        # fold i trains on the earlier blocks only; later rows take no part
        return [(blocks.filter(F.col("block") <= i)
                 .withColumn("fold", F.when(F.col("block") == i, 0).otherwise(1)), 1)
                for i in range(1, k + 1)]
    n = int(settings.get("nr_splits", 3))
    test, part = settings.get("valid_size", 0.25), settings.get("train_size")
    if kind == "ShuffleSplit":
        split = shuffle_split(train, key, n, test, part, seed)
    elif kind == "StratifiedShuffleSplit":
        split = stratified_shuffle_split(train, key, label, n, test, part, seed)
    else:
        raise ValueError(f"unknown validation: {kind}")
    return [(split.filter(F.col(f"split_{i}").isNotNull())
             .withColumn("fold", F.when(F.col(f"split_{i}") == "valid", 0).otherwise(1)), 1)
            for i in range(n)]


def cross_val_score(train: DataFrame, model: str, params: Mapping, settings: Mapping,
                    key: str = "key", label: str = "label", features: str = "features",
                    report: Report | None = None) -> float:
    """Mean score over the folds of the evaluation settings; larger is better."""
    return _score(_with_fold(train, settings, key, label), model, params, settings, key, label,
                  features, report)


def _score(tables: Sequence[tuple[DataFrame, int]], model: str, params: Mapping,
           settings: Mapping, key: str, label: str, features: str,
           report: Report | None) -> float:
    scores: list[float] = []
    for table, k in tables:
        oof = oof_predict(table, model, params, k, key=key, label=label, features=features,
                          report=report).train_oof
        rows = cross_val_scores(oof, settings.get("eval_metric", "neg_log_loss"), label)
        found = [r["score"] for r in rows.collect()]
        if None in found:
            ensure(report).skip("cross_val_score", model, "a fold without a score")
            return float("-inf")
        scores += found
    return sum(scores) / len(scores) if scores else float("-inf")


def _narrowed_space(space: Mapping[str, Mapping], best: Sequence[Mapping]) -> dict:
    """Ranges cut to the values of the best trials, widened by a quarter each way."""
    out = {}
    for name, s in space.items():
        log = s.get("prior") == "log-uniform"
        scale: Callable = math.log if log else float
        values = [scale(b[name]) for b in best]
        margin = 0.25 * ((max(values) - min(values)) or (scale(s["high"]) - scale(s["low"])))
        low, high = min(values) - margin, max(values) + margin
        if log:
            low, high = math.exp(low), math.exp(high)
        low, high = max(low, s["low"]), min(high, s["high"])
        if s["type"] == "integer":
            low, high = math.floor(low), max(math.ceil(high), math.floor(low))
        out[name] = {**s, "low": low, "high": high}
    return out


def search(train: DataFrame, task: str, model: str, config: Mapping, key: str = "key",
           label: str = "label", features: str = "features", folder: str | None = None,
           parallelism: int = 4, report: Report | None = None) -> tuple[dict, DataFrame]:
    """(best parameters, trial table). ``folder`` stores the parameters by task.

    With a folder every trial is saved when it ends, and so is the best one so far.
    The split is made and written once, for all trials.

    The first ``n_inits`` trials cover the whole space; the others are drawn
    from ranges round the best of them. Trials of a phase run side by side.
    """
    report = ensure(report)
    spark: SparkSession = train.sparkSession
    run, settings = config.get("search_settings", {}), config.get("evaluation_settings", {})
    space, fixed = config.get("search_space", {}), config.get("initialize", {})
    calls, inits = int(run.get("n_calls", 15)), int(run.get("n_inits", 10))
    seed = int(run.get("random_state", 42))
    done: list[tuple[int, dict, float]] = []
    tables = [(materialise(table), k) for table, k in _with_fold(train, settings, key, label)]
    lock, top_score = Lock(), [float("-inf")]

    def keep(trial: int, params: Mapping, score: float) -> None:
        with lock:
            save_params(spark, folder, task, {**fixed, **params}, score, trial)
            if score > top_score[0]:
                top_score[0] = score
                save_params(spark, folder, task, {**fixed, **params}, score)

    def phase(first: int, last: int, ranges: Mapping) -> None:
        rows = sample_trials(spark.range(first, last).withColumnRenamed("id", "trial"),
                             ranges, seed).collect()
        drawn_params = [{n: r[n] for n in sorted(ranges)} for r in rows]

        def one(trial: int, p: Mapping) -> Callable[[], float]:
            def scored() -> float:
                score = _score(tables, model, {**fixed, **p}, settings, key, label, features,
                               report)
                if folder:
                    keep(trial, p, score)
                return score
            return scored

        scores = run_parallel([one(r["trial"], p) for r, p in zip(rows, drawn_params)],
                              parallelism)
        done.extend((r["trial"], p, s) for r, p, s in zip(rows, drawn_params, scores))

    first = min(inits, calls)
    phase(0, first, space)
    if calls > first:
        top = sorted(done, key=lambda d: (-d[2], d[0]))[:max(1, first // 2)]
        phase(first, calls, _narrowed_space(space, [p for _, p, _ in top]))
    trials = spark.createDataFrame(
        [(task, t, json.dumps(p, sort_keys=True), s) for t, p, s in done],
        "task string, trial bigint, params string, score double")
    best = best_trial(trials).first()
    params = {**fixed, **json.loads(best["params"])}
    if folder:
        save_params(spark, folder, task, params, best["score"])
    return params, best_so_far(trials)


def search_models(train: DataFrame, configs: Mapping[str, Mapping], key: str = "key",
                  label: str = "label", features: str = "features", folder: str | None = None,
                  parallelism: int = 4, report: Report | None = None,
                  ) -> tuple[dict[str, dict], DataFrame | None]:
    """(best parameters by task, trials of all tasks) of one search per task.

    A config is that of ``search`` with the ``model`` to fit. A task whose search fails is reported
    and skipped; without any other there are no trials (None). The rows are written once.
    """
    report, best, tables = ensure(report), {}, []
    rows = materialise(train)
    for task, config in configs.items():
        try:
            best[task], trials = search(rows, task, config["model"], config, key, label, features,
                                        folder, parallelism, report)
        except Exception as error:  # whatever one model's fits raise, the others go on
            report.skip("search_models", task, f"{type(error).__name__}: {error}")
            continue
        tables.append(trials)
    return best, union_rows(tables) if tables else None
