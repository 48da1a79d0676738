"""Two-level stacking: out-of-fold meta features, then a second round on top."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from featherloom.ml.matrix import assemble, materialise
from featherloom.ml.models import fit, oof_predict, refit_full
from featherloom.naming import meta_name, quoted
from featherloom.operators.interact import pair_geometric
from featherloom.operators.joins import outer_align, reindex, union_rows
from featherloom.operators.metrics import roc_auc
from featherloom.operators.rank import pct_rank
from featherloom.operators.schema import feature_columns
from featherloom.operators.splits import kfold, stratified_kfold
from featherloom.operators.topk import mean_by_key
from featherloom.report import Report, ensure


def resolve_params(zoo: DataFrame, tuned: DataFrame, task: str = "task",
                   ) -> DataFrame:
    """Zoo parameters of every task, each replaced by its tuned value if there is one.

    Both tables hold one row per task; columns of the same name are parameters.
    """
    own = [c for c in zoo.columns if c != task]
    shared = [c for c in own if c in tuned.columns]
    renamed = tuned.select(quoted(task), *[quoted(c).alias(f"__tuned_{c}") for c in shared])
    joined = zoo.join(renamed, task, "left")
    return joined.select(quoted(task), *[
        F.coalesce(quoted(f"__tuned_{c}"), quoted(c)).alias(c) if c in shared else quoted(c)
        for c in own])


def resolve_model(spec: Mapping, zoo: Mapping[str, Mapping],
                  tuned: Mapping[str, Mapping] | None = None) -> tuple[str, dict]:
    """(model, parameters) of a spec or zoo entry.

    Tuned parameters of the entry's task replace its own; a base estimator
    given by name is looked up in the zoo.
    """
    task = spec.get("task")
    params = dict(spec.get("params", {}))
    if task in zoo:
        params = dict(zoo[task].get("params", params))
        task = zoo[task].get("task", task)
    if task and tuned and tuned.get(task):
        params = dict(tuned[task])
    base = params.get("base_estimator")
    if isinstance(base, str) and base in zoo:
        model, base_params = resolve_model(zoo[base], zoo, tuned)
        params["base_estimator"] = {"model": model, "params": base_params}
    return spec["model"], params


@dataclass
class Stacked:
    """Output of one stacker."""

    train_meta: DataFrame
    test_meta: DataFrame
    train_pred: DataFrame
    test_pred: DataFrame
    base_auc: dict[str, float]
    base_predictions: list[DataFrame] = field(default_factory=list)


def fit_stacker(train: DataFrame, test: DataFrame, spec: Mapping,
                bases: Sequence[tuple[str, Mapping]], meta: tuple[str, Mapping],
                key: str, label: str, columns: Sequence[str],
                report: Report | None = None) -> Stacked:
    """One stacker: out-of-fold probabilities of every base feed the meta model.

    Meta features are both class probabilities of each base, in base order. For
    test rows they come from bases refit on all train rows.
    """
    report = ensure(report)
    name, folds = spec["name"], int(spec.get("cv", 3))
    seed = int(spec.get("seed", 42))
    original = bool(spec.get("use_features", True))
    if spec.get("stratify", True):
        train = stratified_kfold(train, key, label, folds, seed)
    else:
        train = kfold(train, key, folds, seed)
    keep = [quoted(c) for c in columns] if original else []
    train = materialise(assemble(train, columns).select(
        quoted(key), quoted(label), "fold", "features", *keep))
    test = materialise(assemble(test, columns).select(quoted(key), "features", *keep))

    train_parts, test_parts, singles, auc = [], [], [], {}
    for i, (model, params) in enumerate(bases):
        oof = oof_predict(train, model, params, folds, key=key, label=label,
                          report=report).train_oof
        full = refit_full(train, test, model, params, [], key, label, report=report)
        both = [(F.lit(1.0) - F.col("proba")).alias(meta_name(name, 2 * i)),
                F.col("proba").alias(meta_name(name, 2 * i + 1))]
        train_parts.append(oof.select(quoted(key), *both))
        test_parts.append(full.select(quoted(key), *both))
        singles.append(full)
    # every part holds the same keys, one row each
    train_meta = materialise(outer_align(train_parts, key))
    test_meta = materialise(outer_align(test_parts, key))
    labelled = train.select(quoted(key), quoted(label), *keep).join(train_meta, key)
    unlabelled = test.select(quoted(key), *keep).join(test_meta, key)
    inputs = [meta_name(name, j) for j in range(2 * len(bases))]
    for i in range(len(bases)):
        auc[f"base_{i}"] = roc_auc(labelled, inputs[2 * i + 1], label).first()["auc"]
    final_columns = [*(columns if original else []), *inputs]
    final = fit(meta[0], meta[1], assemble(labelled, final_columns), label, key=key,
                report=report)

    def scored(df: DataFrame) -> DataFrame:
        return final.predict(assemble(df, final_columns), "proba").select(quoted(key), "proba")

    return Stacked(train_meta, test_meta, scored(labelled), scored(unlabelled), auc, singles)


def stack_fit_transform(train: DataFrame, test: DataFrame, specs: Sequence[Mapping],
                        zoo: Mapping[str, Mapping], key: str, label: str,
                        columns: Sequence[str], tuned: Mapping | None = None,
                        report: Report | None = None,
                        ) -> tuple[DataFrame, DataFrame, dict[str, Stacked]]:
    """Level 1: (train meta features, test meta features, stackers by name)."""
    done: dict[str, Stacked] = {}
    for spec in specs:
        bases = [resolve_model(zoo[s], zoo, tuned) for s in spec["sources"]]
        done[spec["name"]] = fit_stacker(
            train, test, spec, bases, _meta_model(spec, zoo, tuned), key, label, columns, report)
    return (outer_align([s.train_meta for s in done.values()], key),
            outer_align([s.test_meta for s in done.values()], key), done)


def _meta_model(spec: Mapping, zoo: Mapping, tuned: Mapping | None) -> tuple[str, dict]:
    return resolve_model({"model": spec["meta_classifier"], "params": spec.get("params", {}),
                          "task": spec.get("task")}, zoo, tuned)


def external_feature(runs: Sequence[DataFrame], key: str, name: str) -> DataFrame:
    """Mean probability per key over runs, as a percentile rank."""
    mean = mean_by_key(union_rows([r.select(quoted(key), "proba") for r in runs]), key)
    return pct_rank(mean, ["proba"]).withColumnRenamed("proba", name)


def stack_meta_inputs(external: Mapping[str, Sequence[DataFrame]], meta: DataFrame | None,
                      keys: DataFrame, key: str) -> DataFrame:
    """All inputs of level 2 for the given keys.

    External sources and level-1 features become percentile ranks, are aligned
    by key, extended by the geometric mean of every pair, and cut to the keys.
    A source without runs is left out.
    """
    parts = [external_feature(runs, key, name) for name, runs in external.items() if runs]
    if meta is not None:
        parts.append(pct_rank(meta, feature_columns(meta, [key])))
    aligned = outer_align(parts, key)
    return reindex(pair_geometric(aligned, feature_columns(aligned, [key])), keys, key)


def stack_fit_predict(train: DataFrame, test: DataFrame, specs: Sequence[Mapping],
                      zoo: Mapping[str, Mapping], key: str, label: str,
                      external: tuple[Mapping, Mapping] = ({}, {}),
                      meta: tuple[DataFrame | None, DataFrame | None] = (None, None),
                      tuned: Mapping | None = None, report: Report | None = None,
                      ) -> dict[str, Stacked]:
    """Level 2: stackers on external and level-1 features only."""
    train_in = stack_meta_inputs(external[0], meta[0], train, key)
    test_in = materialise(stack_meta_inputs(external[1], meta[1], test, key))
    columns = feature_columns(train_in, [key])
    labelled = materialise(train.select(quoted(key), quoted(label)).join(train_in, key, "left"))
    out: dict[str, Stacked] = {}
    for spec in specs:
        bases = [resolve_model(b, zoo, tuned) for b in spec["base_classifiers"]]
        out[spec["name"]] = fit_stacker(
            labelled, test_in, spec, bases, _meta_model(spec, zoo, tuned), key, label, columns,
            report)
    return out
