"""Classifiers, out-of-fold runs, search and stacking on the driver tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.ml.functions import array_to_vector

from featherloom.functions.columns import key_digest, unit_interval
from featherloom.ml.ensembles import random_thresholds
from featherloom.ml.huber import fit_modified_huber
from featherloom.ml.matrix import assemble, materialise
from featherloom.ml.models import OutOfFold, cross_val_scores, fit, nb_class_stats, \
    oof_predict, refit_full
from featherloom.ml.neighbours import knn_votes
from featherloom.ml.runs import load_external, produce_oof, run_stack
from featherloom.ml.search import integer, real, sample_trials, search, search_models
from featherloom.ml.stack import (
    resolve_params, stack_fit_predict, stack_fit_transform, stack_meta_inputs)
from featherloom.naming import run_folder
from featherloom.operators.clean import split_labelled
from featherloom.operators.encode import one_hot
from featherloom.operators.joins import union_rows
from featherloom.operators.schema import feature_columns
from featherloom.operators.splits import stratified_kfold
from featherloom.queries import fixtures as fx
from featherloom.queries.registry import query, rounded
from featherloom.report import Report
from featherloom.sources.store import read_store, shared_folder, write_store


def _embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return fx.vectors(spark, folder).select(
        F.col("vec_id").alias("key"), "label", "digit", array_to_vector("x").alias("features"))


def _fitted(spark: SparkSession, folder: str, model: str, params: Mapping) -> DataFrame:
    """Fits on all vectors and scores them."""
    rows = _embeddings(spark, folder)
    return fit(model, params, rows).predict(rows, "proba").select("key", "label", "proba")


@query("model_gbt")
def model_gbt(spark: SparkSession, folder: str) -> DataFrame:
    return _fitted(spark, folder, "LGBMClassifier", {
        "n_estimators": 5, "max_depth": 3, "learning_rate": 0.3, "subsample": 0.9,
        "colsample_bytree": 0.9, "scale_pos_weight": 1.2, "num_leaves": 20, "seed": 42})


@query("model_random_forest")
def model_random_forest(spark: SparkSession, folder: str) -> DataFrame:
    return _fitted(spark, folder, "RandomForestClassifier", {
        "n_estimators": 10, "criterion": "gini", "max_depth": 5, "min_samples_leaf": 4,
        "oob_score": True, "class_weight": "balanced", "random_state": 42})


@query("model_extra_trees")
def model_extra_trees(spark: SparkSession, folder: str) -> DataFrame:
    return _fitted(spark, folder, "ExtraTreesClassifier", {
        "n_estimators": 10, "criterion": "entropy", "max_depth": 5, "min_samples_leaf": 4,
        "random_state": 42})


@query("model_forest_bags", """
with u as (
  select vec_id as key, i as tree, ('0x' || md5(vec_id || '|' || (42 + i))[:8])::bigint
         / 4294967296.0 as u
  from embeddings, (select unnest(range(8)) as i))
select key, cast(count_if(u < exp(-1.0)) as int) as vote_trees,
       count_if(u < exp(-1.0)) > 0 as voted, true as valid
from u group by key""")
def model_forest_bags(spark: SparkSession, folder: str) -> DataFrame:
    """Out-of-bag votes: a row is judged by exactly the trees whose bags lack it."""
    rows = materialise(_embeddings(spark, folder))
    model = fit("RandomForestClassifier", {"n_estimators": 8, "max_depth": 4, "oob_score": True,
                                           "random_state": 42}, rows)
    return model.out_of_bag(rows, "vote").select(
        "key", "vote_trees", F.col("vote").isNotNull().alias("voted"),
        F.coalesce(F.col("vote").between(0, 1), F.lit(True)).alias("valid"))


@query("model_oob_score")
def model_oob_score(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy of the out-of-bag votes, and the share of rows that have any."""
    rows = materialise(_embeddings(spark, folder))
    model = fit("RandomForestClassifier", {"n_estimators": 8, "max_depth": 4, "oob_score": True,
                                           "random_state": 42}, rows)
    right = ((F.col("vote") > 0.5).cast("int") == F.col("label")).cast("double")
    return model.out_of_bag(rows, "vote").agg(
        F.avg(right).alias("oob_score"),
        F.avg(F.col("vote").isNotNull().cast("double")).alias("covered"))


@query("extra_trees_thresholds", """
with x as (select unnest(embedding)::double as value,
                  generate_subscripts(embedding, 1) - 1 as feature from embeddings),
e as (select feature, min(value) as low, max(value) as high from x group by feature)
select tree::int as tree, feature::int as feature, number::int as number, round(low + ('0x' || md5(
         feature || '|' || tree || '|' || number || '|42')[:8])::bigint / 4294967296.0
         * (high - low), 6) as cut
from e, (select unnest(range(10)) as tree), (select unnest(range(16)) as number)""")
def extra_trees_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    """The random cut points of each tree."""
    return rounded(random_thresholds(_embeddings(spark, folder), "features", 10, 42))


@query("model_modified_huber", """
select vec_id as key, true as in_range, true as falls, true as least from embeddings""")
def model_modified_huber(spark: SparkSession, folder: str) -> DataFrame:
    """The objective falls in every pass, and its minimum is reached (no slope is left)."""
    rows = materialise(_embeddings(spark, folder))
    model = fit_modified_huber(rows, "features", "label", alpha=0.001, l1_ratio=0.15)
    pairs = zip(model.objectives, model.objectives[1:], strict=False)
    return model.predict(rows, "features", "proba").select(
        "key", F.col("proba").between(0, 1).alias("in_range"),
        F.lit(all(a > b for a, b in pairs)).alias("falls"),
        F.lit(model.residual < 1e-5).alias("least"))


@query("model_elastic_net")
def model_elastic_net(spark: SparkSession, folder: str) -> DataFrame:
    return _fitted(spark, folder, "SGDClassifier", {
        "loss": "log", "penalty": "elasticnet", "l1_ratio": 0.15, "alpha": 0.001,
        "max_iter": 30, "class_weight": "balanced"})


@query("model_gaussian_nb", """
with x as (select vec_id, (label > 4)::int as label, unnest(embedding)::double as v,
                  generate_subscripts(embedding, 1) as i from embeddings),
e as (select max(s) * 1e-9 as least from (select var_pop(v) as s from x group by i)),
c as (select label, i, avg(v) as m, var_pop(v) + (select least from e) as s from x group by 1, 2),
p as (select (label > 4)::int as label, ln(count(*) / (select count(*) from embeddings)) as prior
      from embeddings group by 1),
l as (select x.vec_id, c.label, sum(-0.5 * (ln(2 * pi() * s) + (v - m) * (v - m) / s)) as fit
      from x join c using (i) group by 1, 2),
f as (select vec_id, sum(case when p.label = 1 then fit + prior end)
             - sum(case when p.label = 0 then fit + prior end) as odds
      from l join p using (label) group by 1)
select vec_id as key, (label > 4)::int as label, round(1 / (1 + exp(-odds)), 6) as proba
from embeddings join f using (vec_id)""")
def model_gaussian_nb(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_fitted(spark, folder, "GaussianNB", {}))


@query("nb_class_stats", """
select label, count(*) as n, round(avg(embedding[1]), 6) as e0_mean,
       round(var_pop(embedding[1]), 6) as e0_var, round(avg(embedding[2]), 6) as e1_mean,
       round(var_pop(embedding[2]), 6) as e1_var,
       round(count(*) / (select count(*) from embeddings), 6) as prior
from (select label, embedding::double[] as embedding from embeddings) group by label""")
def class_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.vectors(spark, folder).select(
        F.col("digit").alias("label"), F.col("x")[0].alias("e0"), F.col("x")[1].alias("e1"))
    return rounded(nb_class_stats(rows, "label", ["e0", "e1"]))


@query("model_knn", """
with v as (select vec_id, label, embedding::double[] as x from embeddings),
near as (
  select q.vec_id, t.label,
         list_sum(list_transform(list_zip(q.x, t.x), lambda p: abs(p[1] - p[2]))) as d,
         t.vec_id as other
  from v q join v t on q.vec_id <> t.vec_id),
best as (
  select *, row_number() over (partition by vec_id order by d, other) as r from near),
votes as (
  select vec_id, label, case when min(d) over (partition by vec_id) = 0
                             then (d = 0)::int else 1 / d end as w
  from best where r <= 13)
select vec_id, label, round(sum(w) / (sum(sum(w)) over (partition by vec_id)), 6) as proba
from votes group by vec_id, label""")
def model_knn(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.vectors(spark, folder).select("vec_id", F.col("digit").alias("label"), "x")
    return rounded(knn_votes(rows, rows, "vec_id", "x", "label", k=13, p=1, exclude_self=True))


@query("model_bagging")
def model_bagging(spark: SparkSession, folder: str) -> DataFrame:
    return _fitted(spark, folder, "BaggingClassifier", {
        "base_estimator": {"model": "SGDClassifier", "params": {"max_iter": 10}},
        "n_estimators": 4, "max_samples": 0.9, "max_features": 0.8, "random_state": 42})


_OOF_PARAMS = {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.3, "seed": 42}


def _oof(spark: SparkSession, folder: str, model: str, params: Mapping,
         **options) -> tuple[DataFrame, DataFrame, OutOfFold]:
    """Out-of-fold run on the labelled documents, with the unlabelled ones as test."""
    train, test, columns = _documents(spark, folder)
    train = materialise(assemble(stratified_kfold(train, "doc_id", "target", 3, 1001), columns)
                        .select("doc_id", "target", "fold", "features"))
    test = materialise(assemble(test, columns).select("doc_id", "features"))
    out = oof_predict(train, model, params, 3, test, "doc_id", "target", feature_names=columns,
                      **options)
    return train, test, out


def _documents(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """(labelled, unlabelled, feature names) with dummies and whole-text measures."""
    texts = fx.table(spark, folder, "documents").select(
        "doc_id", F.size(F.split("text", r"\s+")).alias("n_words"),
        F.length(F.regexp_replace("text", r"[^0-9]", "")).alias("n_digits"),
        F.size(F.split("text", "\n")).alias("n_lines"))
    rows = fx.labelled(spark, folder).join(texts, "doc_id")
    rows, _, _ = one_hot(rows, ["lang", "source"])
    train, test = split_labelled(rows, "target")
    return train, test, feature_columns(rows, ["doc_id", "target"])


@query("model_oof")
def model_oof(spark: SparkSession, folder: str) -> DataFrame:
    train, test, run = _oof(spark, folder, "LGBMClassifier", _OOF_PARAMS)
    path = shared_folder(spark)
    write_store(spark, path, run.bundle())
    stored = read_store(spark, path)
    return (stored["train_oof"].select("doc_id", "proba", F.lit("train_oof").alias("part"))
            .union(stored["test_oof"].select("doc_id", "proba", F.lit("test_oof"))))


@query("model_early_stopping")
def model_early_stopping(spark: SparkSession, folder: str) -> DataFrame:
    params = {**_OOF_PARAMS, "n_estimators": 8, "validation_tol": 0.01}
    _, _, run = _oof(spark, folder, "LGBMClassifier", params, early_stopping=True)
    best = F.array(*[F.lit(i) for i in run.iterations])
    return run.train_oof.withColumn("iterations", F.get(best, F.col("fold")))


_PATIENT = {**_OOF_PARAMS, "n_estimators": 24, "learning_rate": 0.5, "early_stopping_rounds": 3}


@query("model_loss_curve")
def model_loss_curve(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out loss of every round of each fold's model, and the round that it keeps."""
    return _oof(spark, folder, "LGBMClassifier", _PATIENT, early_stopping=True)[2].loss_curves


@query("model_best_round", """
select unnest([0, 1, 2])::int as fold, true as least, true as same_loss, true as patient
where (select count(*) from documents join labels using (doc_id)) > 0""")
def model_best_round(spark: SparkSession, folder: str) -> DataFrame:
    """Each fold keeps the round of least held-out loss, and its predictions have that loss."""
    _, _, run = _oof(spark, folder, "LGBMClassifier", _PATIENT, early_stopping=True)
    curve = run.loss_curves.groupBy("fold").agg(
        F.min("loss").alias("low"), F.max(F.when(F.col("kept"), F.col("loss"))).alias("loss"),
        F.max(F.when(F.col("kept"), F.col("round"))).alias("best"), F.max("round").alias("seen"))
    true = F.when(F.col("target") == 1, F.col("proba")).otherwise(1 - F.col("proba"))
    # the boosted loss is twice the log loss
    got = run.train_oof.groupBy("fold").agg((F.avg(-F.log(true)) * 2).alias("own"))
    return curve.join(got, "fold").select(
        "fold", (F.col("loss") == F.col("low")).alias("least"),
        (F.abs(F.col("own") - F.col("loss")) < 1e-6).alias("same_loss"),
        ((F.col("seen") == F.col("best") + 3) | (F.col("seen") == 24)).alias("patient"))


@query("model_refit_full")
def model_refit_full(spark: SparkSession, folder: str) -> DataFrame:
    train, test, run = _oof(spark, folder, "LGBMClassifier", _OOF_PARAMS)
    return refit_full(train, test, "LGBMClassifier", _OOF_PARAMS, run.iterations, "doc_id",
                      "target")


@query("model_refit_coverage", """
select doc_id, true as valid from documents left join labels using (doc_id)
where quality is null""")
def model_refit_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """The refit on all labelled documents predicts every other one once."""
    return model_refit_full(spark, folder).select(
        "doc_id", F.col("proba").between(0, 1).alias("valid"))


@query("model_bagging_coverage", """
select vec_id as key, true as valid from embeddings""")
def model_bagging_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector has one mean probability of all bags."""
    return model_bagging(spark, folder).select("key", F.col("proba").between(0, 1).alias("valid"))


@query("model_importance")
def model_importance(spark: SparkSession, folder: str) -> DataFrame:
    _, _, run = _oof(spark, folder, "RandomForestClassifier", {
        "n_estimators": 5, "max_depth": 4, "random_state": 42})
    return run.importances


@query("model_oof_coverage", """
select doc_id, cast(1 as bigint) as n, true as valid from documents join labels using (doc_id)
where quality is not null""")
def model_oof_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Every labelled document is predicted exactly once."""
    return model_oof(spark, folder).where("part = 'train_oof'").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("proba").between(0, 1)).alias("valid"))


@query("model_importance_sums", """
select unnest([1, 2, 3])::int as fold, 1.0::double as whole
where (select count(*) from documents) > 0""")
def model_importance_sums(spark: SparkSession, folder: str) -> DataFrame:
    """The importances of each fold's model sum to 1."""
    return model_importance(spark, folder).groupBy("fold").agg(
        F.round(F.sum("importance"), 6).alias("whole"))


@query("stack_bundles", """
select doc_id, run, case when quality is null then 'test' else 'train' end as part, true as valid
from documents left join labels using (doc_id), (select unnest([0, 1])::int as run)""")
def stack_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """Out-of-fold runs with a plain and a stratified split, written and read back by name."""
    train, test, columns = _documents(spark, folder)
    store = shared_folder(spark)
    keys = ["doc_id", *columns]
    names = produce_oof(train.select(*keys, "target"), test.select(*keys), "SGDClassifier",
                        {"max_iter": 5}, store, "doc_id", "target", n_folds=2,
                        early_stopping=False)
    halves = zip(("train", "test"), load_external(spark, store, {"A": names}))
    return union_rows([
        rows.select("doc_id", F.lit(i).alias("run"), F.lit(part).alias("part"),
                    F.col("proba").between(0, 1).alias("valid"))
        for part, found in halves for i, rows in enumerate(found["A"])])


SPACE = {
    "learning_rate": real(1e-3, 1e-1, "log-uniform"),
    "subsample": real(0.6, 0.9),
    "max_depth": integer(2, 6),
}


@query("trials_sample", """
with u as (
  select o_orderkey as trial, o_orderpriority as task,
         ('0x' || md5('learning_rate|' || o_orderkey || '|42')[:8])::bigint / 4294967296.0 as a,
         ('0x' || md5('subsample|' || o_orderkey || '|42')[:8])::bigint / 4294967296.0 as b,
         ('0x' || md5('max_depth|' || o_orderkey || '|42')[:8])::bigint / 4294967296.0 as c
  from orders)
select trial, task, round(0.001 * exp(a * ln(100.0)), 9) as learning_rate,
       round(0.6 + b * 0.3, 9) as subsample, cast(2 + floor(c * 5) as int) as max_depth
from u""")
def trials_sample(spark: SparkSession, folder: str) -> DataFrame:
    orders = fx.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("trial"), F.col("o_orderpriority").alias("task"))
    return rounded(sample_trials(orders, SPACE), 9)


@query("resolve_params", fx.FX + """, zoo as (
  select event_type as task, count(*) as n_estimators, min(value) as learning_rate,
         cast(max(length(props)) as int) as max_depth from events group by event_type),
tuned as (
  select task, cast(score * 10 as int) as n_estimators, score / 8 as learning_rate from (
    select *, row_number() over (partition by task order by score desc, trial) as r
    from fx_trials where task <> 'view') where r = 1)
select zoo.task, cast(coalesce(tuned.n_estimators, zoo.n_estimators) as bigint) as n_estimators,
       coalesce(tuned.learning_rate, zoo.learning_rate) as learning_rate, max_depth
from zoo left join tuned using (task)""")
def params(spark: SparkSession, folder: str) -> DataFrame:
    from featherloom.operators.topk import best_trial
    zoo = fx.table(spark, folder, "events").groupBy(F.col("event_type").alias("task")).agg(
        F.count(F.lit(1)).alias("n_estimators"), F.min("value").alias("learning_rate"),
        F.max(F.length("props")).alias("max_depth"))
    best = best_trial(fx.trials(spark, folder).filter("task <> 'view'"))
    tuned = best.select("task", F.round(F.col("score") * 10).cast("bigint").alias("n_estimators"),
                        (F.col("score") / 8).alias("learning_rate"))
    return resolve_params(zoo, tuned)


@query("search_cv_score")
def search_cv_score(spark: SparkSession, folder: str) -> DataFrame:
    _, _, run = _oof(spark, folder, "RandomForestClassifier", {
        "n_estimators": 5, "max_depth": 4, "random_state": 42})
    return cross_val_scores(run.train_oof, "roc_auc", "target")


@query("search_fold_scores", fx.FX + """,
p as (select cast(c_custkey % 3 as int) as fold, target::int as y,
             ('0x' || md5(c_custkey || '|1')[:8])::bigint / 4294967296.0 as p
      from fx_main where target is not null),
r as (select *, rank() over (partition by fold order by p)
                + (count(*) over (partition by fold, p) - 1) / 2 as r from p)
select fold, round((sum(r) filter (y = 1) - sum(y) * (sum(y) + 1) / 2)
                   / (sum(y) * (count(*) - sum(y))), 9) as auc,
       round(avg(ln(case when y = 1 then p else 1 - p end)), 9) as neg_log_loss
from r group by fold""")
def search_fold_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of each fold by two metrics; larger is better in both."""
    rows = fx.main(spark, folder).where("target is not null").select(
        (F.col("c_custkey") % 3).cast("int").alias("fold"), F.col("target").cast("int").alias("y"),
        unit_interval(key_digest(F.col("c_custkey"), 1)).alias("proba"))
    auc, loss = (cross_val_scores(rows, metric, "y").withColumnRenamed("score", name)
                 for metric, name in (("roc_auc", "auc"), ("neg_log_loss", "neg_log_loss")))
    return rounded(auc.join(loss, "fold"), 9)


@query("search_models", """
with u as (
  select trial, ('0x' || md5('alpha|' || trial || '|42')[:8])::bigint / 4294967296.0 as a,
         ('0x' || md5('l1_ratio|' || trial || '|42')[:8])::bigint / 4294967296.0 as b
  from (select unnest(range(2)) as trial) where (select count(*) from embeddings) > 0)
select 'Linear' as task, trial, round(0.0001 * exp(a * ln(1000.0)), 9) as alpha,
       round(b * 0.5, 9) as l1_ratio, true as rising from u""")
def searches(spark: SparkSession, folder: str) -> DataFrame:
    """One search fails and is skipped; the other's first trials are the draws of the whole space."""
    config = {"search_settings": {"n_calls": 2, "n_inits": 2, "random_state": 42},
              "evaluation_settings": {"validation": "StratifiedKFold", "nr_fold": 2,
                                      "split_seed": 538, "eval_metric": "roc_auc"},
              "initialize": {"max_iter": 5},
              "search_space": {"alpha": real(1e-4, 1e-1, "log-uniform"),
                               "l1_ratio": real(0.0, 0.5)}}
    report = Report()
    best, trials = search_models(
        _embeddings(spark, folder), {"Unknown": {"model": "NoSuchModel", **config},
                                     "Linear": {"model": "SGDClassifier", **config}},
        report=report)
    assert list(best) == ["Linear"] and report.names("search_models") == ["Unknown"]
    drawn = F.from_json("params", "alpha double, l1_ratio double")
    return rounded(trials.select(
        "task", "trial", drawn["alpha"].alias("alpha"), drawn["l1_ratio"].alias("l1_ratio"),
        (F.col("best_score") >= F.col("score")).alias("rising")), 9)


@query("search_trials")
def search_trials(spark: SparkSession, folder: str) -> DataFrame:
    rows = materialise(_embeddings(spark, folder))
    _, trials = search(rows, "LinearModel", "SGDClassifier", {
        "search_settings": {"n_calls": 3, "n_inits": 2, "random_state": 42},
        "evaluation_settings": {"validation": "StratifiedKFold", "nr_fold": 2,
                                "split_seed": 538, "eval_metric": "roc_auc"},
        "initialize": {"max_iter": 10},
        "search_space": {"alpha": real(1e-4, 1e-1, "log-uniform"), "l1_ratio": real(0.0, 0.5)}},
        folder=shared_folder(spark))
    return trials


ZOO = {
    "GaussianNB": {"model": "GaussianNB", "params": {}},
    "LR": {"model": "SGDClassifier", "params": {
        "loss": "log", "penalty": "elasticnet", "l1_ratio": 0.15, "max_iter": 10}},
    "RF": {"model": "RandomForestClassifier", "task": "ScikitRF",
           "params": {"n_estimators": 5, "max_depth": 4, "random_state": 42}},
}
LEVEL1 = [{"name": "LinearStacker", "meta_classifier": "SGDClassifier",
           "params": {"l1_ratio": 0.15, "max_iter": 10}, "cv": 2, "seed": 538,
           "use_features": False, "stratify": True, "sources": ["LR", "GaussianNB"]}]
LEVEL2 = [{"name": "TopStacker", "meta_classifier": "SGDClassifier",
           "params": {"l1_ratio": 0.15, "max_iter": 10}, "cv": 2, "seed": 538,
           "use_features": False, "stratify": True, "base_classifiers": [
               {"model": "SGDClassifier", "params": {"max_iter": 10}},
               {"model": "RandomForestClassifier",
                "params": {"n_estimators": 4, "max_depth": 3, "random_state": 42}}]}]


@query("stack_level1")
def stack_level1(spark: SparkSession, folder: str) -> DataFrame:
    train, test, columns = _documents(spark, folder)
    train_meta, test_meta, _ = stack_fit_transform(train, test, LEVEL1, ZOO, "doc_id", "target",
                                                   columns)
    return (train_meta.withColumn("part", F.lit("train"))
            .unionByName(test_meta.withColumn("part", F.lit("test"))))


@query("stack_level2")
def stack_level2(spark: SparkSession, folder: str) -> DataFrame:
    train, test, columns = _documents(spark, folder)
    train_meta, test_meta, _ = stack_fit_transform(train, test, LEVEL1, ZOO, "doc_id", "target",
                                                   columns)
    source = {"Length": [test.select("doc_id", (F.col("n_chars") / 1e6).alias("proba"))]}
    known = {"Length": [train.select("doc_id", (F.col("n_chars") / 1e6).alias("proba"))]}
    out = stack_fit_predict(train, test, LEVEL2, ZOO, "doc_id", "target", (known, source),
                            (train_meta, test_meta))
    return out["TopStacker"].test_pred


@query("stack_level1_pairs", """
select doc_id, case when quality is null then 'test' else 'train' end as part, true as whole
from documents left join labels using (doc_id)""")
def stack_level1_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Level 1 gives every document one row, and the two features of each base sum to 1."""
    rows = stack_level1(spark, folder)
    values = [c for c in rows.columns if c not in ("doc_id", "part")]
    pairs = [F.abs(F.col(a) + F.col(b) - 1) < 1e-9
             for a, b in zip(values[::2], values[1::2], strict=True)]
    return rows.select("doc_id", "part", F.array_min(F.array(*pairs)).alias("whole"))


@query("stack_run", """
select doc_id, level, name, true as valid
from documents left join labels using (doc_id), (values
  (1, 'LinearStacker_base0'), (1, 'LinearStacker_base1'), (1, 'LinearStacker'),
  (2, 'TopStacker_base0'), (2, 'TopStacker_base1'), (2, 'TopStacker')) runs(level, name)
where quality is null""")
def stack_run(spark: SparkSession, folder: str) -> DataFrame:
    """Both levels written and read back: every run predicts each unlabelled document once."""
    train, test, columns = _documents(spark, folder)
    store = shared_folder(spark)
    levels = run_stack(train, test, ZOO, LEVEL1, LEVEL2, store, "sample", "doc_id", "target",
                       columns, 2)
    return union_rows([
        spark.read.schema("doc_id long, proba double").option("header", True)
        .csv(f"{store}/sample_{run_folder(run)}")
        .select("doc_id", F.lit(level).alias("level"), F.lit(name).alias("name"),
                F.col("proba").between(0, 1).alias("valid"))
        for level, names in levels.items() for name, run in names.items()])


_RANKED = """
  select c_custkey, (rank() over (order by p) + (count(*) over (partition by p) - 1) / 2)
    / count(*) over () as v from """


@query("stack_meta_inputs", fx.FX + """,
runs as (
  select c_custkey, ('0x' || md5(c_custkey || '|1')[:8])::bigint / 4294967296.0 as proba
  from fx_main
  union all
  select c_custkey, ('0x' || md5(c_custkey || '|2')[:8])::bigint / 4294967296.0 as proba
  from fx_main where segment is not null),
ea as (""" + _RANKED + """ (select c_custkey, avg(proba) as p from runs group by 1)),
eb as (""" + _RANKED + """ (select o_custkey as c_custkey, avg(cents / 65536) as p
                            from fx_prev group by 1)),
m as (""" + _RANKED + """ (select c_custkey, floor(c_acctbal / 8) as p from fx_main)),
w as (select c_custkey, ea.v as a, eb.v as b, m.v as m
      from ea full join eb using (c_custkey) full join m using (c_custkey))
select c_custkey, coalesce(a, 0) as "A", coalesce(b, 0) as "B", coalesce(m, 0) as "L_0",
       round(sqrt(coalesce(a, 1) * coalesce(b, 1)), 9) as "A_X_B",
       round(sqrt(coalesce(a, 1) * coalesce(m, 1)), 9) as "A_X_L_0",
       round(sqrt(coalesce(b, 1) * coalesce(m, 1)), 9) as "B_X_L_0"
from w join fx_main using (c_custkey) where target is not null""")
def meta_inputs(spark: SparkSession, folder: str) -> DataFrame:
    main = fx.main(spark, folder)

    def run(seed: int) -> DataFrame:
        return main.select("c_custkey", "segment", unit_interval(
            key_digest(F.col("c_custkey"), seed)).alias("proba"))

    orders = fx.prev(spark, folder).select(F.col("o_custkey").alias("c_custkey"),
                                           (F.col("cents") / 65536).alias("proba"))
    meta = main.select("c_custkey", F.floor(F.col("c_acctbal") / 8).cast("double").alias("L_0"))
    out = stack_meta_inputs(
        {"A": [run(1), run(2).filter("segment is not null")], "B": [orders], "Empty": []},
        meta, main.filter("target is not null"), "c_custkey")
    return out.select(*[F.round(c, 9).alias(c) if "_X_" in c else F.col(c) for c in out.columns])
