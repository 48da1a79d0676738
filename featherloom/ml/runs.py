"""Runs on disk: out-of-fold bundles by name, stacker outputs, and reading them back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from featherloom.ml.matrix import assemble, materialise
from featherloom.ml.models import oof_predict, refit_full
from featherloom.ml.stack import Stacked, stack_fit_predict, stack_fit_transform
from featherloom.naming import format_run_name, quoted, run_folder
from featherloom.operators.importance import DEFAULT_THRESHOLD, blacklist, importance_totals
from featherloom.operators.joins import outer_align, union_rows
from featherloom.operators.metrics import roc_auc
from featherloom.operators.schema import cull_features, feature_columns
from featherloom.operators.splits import kfold, stratified_kfold
from featherloom.report import Report, ensure
from featherloom.sources.store import (
    read_store, write_meta_features, write_predictions, write_store)


def run_name(spark: SparkSession, level: int, model: str, features: int, score: float | None,
             folds: int, time: datetime | None = None) -> str:
    """The public run name; ``time`` (UTC) is now unless given."""
    stamp = (time or datetime.now(timezone.utc)).strftime("%Y-%m-%d %H:%M:%S")
    name = format_run_name(F.lit(level), F.lit(model), F.lit(features), F.lit(score),
                           F.lit(folds), F.lit(stamp).cast("timestamp"))
    return spark.range(1).select(name).first()[0]


def produce_oof(train: DataFrame, test: DataFrame, model: str, params: Mapping, folder: str,
                key: str, label: str, drop: Sequence[str] = (), n_folds: int = 5,
                stratified: Sequence[bool] = (False, True), early_stopping: bool = True,
                seed: int = 42, time: datetime | None = None,
                report: Report | None = None) -> list[str]:
    """One cross-validated run per kind of split, stored as a bundle; returns the run names.

    A bundle holds the out-of-fold and mean test probabilities, those of a refit on all
    train rows with the largest best iteration, and the importances. Columns in ``drop``
    are left out. The name carries the AUC of the out-of-fold rows.
    """
    report = ensure(report)
    spark = train.sparkSession
    columns = [c for c in feature_columns(train, [key, label]) if c not in set(drop)]
    rows = materialise(assemble(train, columns).select(quoted(key), quoted(label), "features"))
    unseen = materialise(assemble(test, columns).select(quoted(key), "features"))
    names = []
    for even in stratified:
        split = materialise(stratified_kfold(rows, key, label, n_folds, seed) if even
                            else kfold(rows, key, n_folds, seed))
        run = oof_predict(split, model, params, n_folds, unseen, key, label,
                          feature_names=columns, early_stopping=early_stopping, report=report)
        run.train_oof = materialise(run.train_oof)
        run.test_full = refit_full(rows, unseen, model, params, run.iterations, key, label,
                                   report=report)
        auc = roc_auc(run.train_oof, "proba", label).first()["auc"]
        kind = f"{model}_{'stratified' if even else 'plain'}"
        name = run_name(spark, 0, kind, len(columns), auc, n_folds, time)
        write_store(spark, f"{folder}/{run_folder(name)}", run.bundle())
        names.append(name)
    return names


def stored_importances(spark: SparkSession, folder: str, names: Sequence[str],
                       report: Report | None = None) -> DataFrame | None:
    """Importance rows of all named runs, one below the other; None if no run has any.

    Runs without importances, or that are missing, are reported and skipped.
    """
    report, found = ensure(report), []
    for name in names:
        table = read_store(spark, f"{folder}/{run_folder(name)}", ["feature_importance"])[
            "feature_importance"]
        if "feature" in table.columns:
            found.append(table.select("feature", F.col("importance").cast("double")))
        else:
            report.skip("stored_importances", name, "no importances stored")
    return union_rows(found) if found else None


def cull_by_runs(df: DataFrame, folder: str, names: Sequence[str],
                 threshold: float = DEFAULT_THRESHOLD, keep: Sequence[str] = (),
                 report: Report | None = None) -> tuple[DataFrame, list[str]]:
    """(table without the features of little importance, their names).

    A feature goes if its importance, summed over all folds of all named runs, is at most
    ``threshold``. Columns in ``keep``, and features that no run lists, stay. Only names of columns
    of ``df`` come to the driver.
    """
    found = stored_importances(df.sparkSession, folder, names, report)
    if found is None:
        return df, []
    mine = [c for c in df.columns if c not in set(keep)]
    low = blacklist(importance_totals(found.where(F.col("feature").isin(mine))), threshold)
    gone = sorted(r["feature"] for r in low.select("feature").collect())
    return cull_features(df, gone), gone


def load_external(spark: SparkSession, folder: str, sources: Mapping[str, Sequence[str]],
                  report: Report | None = None,
                  ) -> tuple[dict[str, list[DataFrame]], dict[str, list[DataFrame]]]:
    """(train, test) out-of-fold tables of the named runs per source; missing runs are reported."""
    report = ensure(report)
    train: dict[str, list[DataFrame]] = {}
    test: dict[str, list[DataFrame]] = {}
    for source, names in sources.items():
        train[source], test[source] = [], []
        for name in names:
            found = read_store(spark, f"{folder}/{run_folder(name)}")
            if "train_oof" not in found or "test_oof" not in found:
                report.skip("load_external", name, "no bundle of this name")
                continue
            train[source].append(found["train_oof"])
            test[source].append(found["test_oof"])
    return train, test


def latest_meta(spark: SparkSession, folder: str, prefix: str, level: int = 1,
                ) -> tuple[DataFrame | None, DataFrame | None]:
    """The newest (train, test) meta features of a level, None where there are none."""
    kind = "meta_features" if level == 1 else "meta_stackers"
    found = read_store(spark, f"{folder}/{prefix}_{kind}")
    return found.get("train_meta"), found.get("test_meta")


def write_stack(spark: SparkSession, folder: str, prefix: str, stacked: Mapping[str, Stacked],
                key: str, label: str, train: DataFrame, folds: int, level: int = 1,
                time: datetime | None = None) -> dict[str, str]:
    """Predictions of every base and meta model, and the meta tables; returns run names.

    A base's run name carries its out-of-fold AUC; a stacker's the AUC on its train rows.
    """
    labels, names = train.select(quoted(key), quoted(label)), {}
    for name, done in stacked.items():
        for i, base in enumerate(done.base_predictions):
            run = run_name(spark, level, f"{name}_base{i}", 0, done.base_auc[f"base_{i}"], folds,
                           time)
            write_predictions(base, f"{folder}/{prefix}_{run_folder(run)}", key, "proba")
            names[f"{name}_base{i}"] = run
        auc = roc_auc(labels.join(done.train_pred, key), "proba", label).first()["auc"]
        run = run_name(spark, level, name, len(done.train_meta.columns) - 1, auc, folds, time)
        write_predictions(done.test_pred, f"{folder}/{prefix}_{run_folder(run)}", key, "proba")
        names[name] = run
    write_meta_features(
        spark, folder, prefix, run, outer_align([s.train_meta for s in stacked.values()], key),
        outer_align([s.test_meta for s in stacked.values()], key), level)
    return names


def run_stack(train: DataFrame, test: DataFrame, zoo: Mapping[str, Mapping],
              level1: Sequence[Mapping], level2: Sequence[Mapping], folder: str, prefix: str,
              key: str, label: str, columns: Sequence[str], folds: int,
              sources: Mapping[str, Sequence[str]] | None = None, tuned: Mapping | None = None,
              time: datetime | None = None, report: Report | None = None,
              ) -> dict[int, dict[str, str]]:
    """Both levels of a stack, each fitted, written and read back; run names by level.

    Level 2 takes the latest meta features of level 1 in ``folder`` and the stored out-of-fold runs
    named in ``sources``. A level without specs is left as it is stored, so a broken run can go on
    at level 2.
    """
    spark, report, names = train.sparkSession, ensure(report), {}
    if level1:
        _, _, done = stack_fit_transform(train, test, level1, zoo, key, label, columns, tuned,
                                         report)
        names[1] = write_stack(spark, folder, prefix, done, key, label, train, folds, 1, time)
    if level2:
        meta = latest_meta(spark, folder, prefix)
        external = load_external(spark, folder, sources or {}, report)
        done = stack_fit_predict(train, test, level2, zoo, key, label, external, meta, tuned,
                                 report)
        names[2] = write_stack(spark, folder, prefix, done, key, label, train, folds, 2, time)
    return names
