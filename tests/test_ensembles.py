"""Patience, out-of-bag votes, random thresholds, modified Huber, routed neighbours."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from featherloom.ml.ensembles import best_round, boost_with_patience, random_thresholds
from featherloom.ml.huber import _pass, fit_modified_huber, optimality
from featherloom.ml.models import fit, oof_predict
from featherloom.ml.neighbours import _vectors, nearest_rows, routes
from featherloom.operators.metrics import roc_auc
from featherloom.report import Report


@pytest.fixture(scope="module")
def rows(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet").select(
        F.col("vec_id").alias("key"), (F.col("label") > 4).cast("int").alias("label"),
        array_to_vector(F.slice(F.col("embedding").cast("array<double>"), 1, 8)).alias("features"))
    return df.cache()


def auc(df):
    return roc_auc(df, "proba", "label").first()[0]


def test_best_round():
    assert best_round([3, 2, 1, 1, 2, 0], 2) == (3, True)
    assert best_round([3, 2, 1, 1, 2, 0], 4) == (6, False)
    assert best_round([float("nan"), 2, 3], 5) == (2, False)
    assert best_round([], 1) == (1, False) and best_round([math.inf, math.inf], 1) == (1, True)


def test_patience_keeps_the_least_loss(rows):
    held = F.col("key") % 3 == 0
    estimator = GBTClassifier(maxIter=40, maxDepth=4, stepSize=0.5, seed=3, labelCol="label")
    model, best, losses = boost_with_patience(estimator, rows.where(~held), rows.where(held), 3)
    assert losses.index(min(losses)) + 1 == best == model.getNumTrees < 40
    assert len(losses) == best + 3
    # the cut ensemble is the one that so many rounds give
    short = estimator.copy({estimator.maxIter: best}).fit(rows.where(~held))
    got, want = (m.transform(rows).select("key", "probability").sort("key").collect()
                 for m in (model, short))
    assert got == want
    again = model.evaluateEachIteration(rows.where(held))
    assert again == pytest.approx(losses[:best])
    whole, n, none = boost_with_patience(
        estimator.copy({estimator.maxIter: 2}), rows, rows.limit(0), 3)
    assert (whole.getNumTrees, n, none) == (2, 2, [])


def test_out_of_fold_run_with_patience(rows):
    run = oof_predict(rows.withColumn("fold", (F.col("key") % 2).cast("int")), "LGBMClassifier",
                      {"n_estimators": 30, "max_depth": 4, "learning_rate": 0.5, "seed": 1,
                       "early_stopping_rounds": 2}, 2, early_stopping=True)
    curves = run.loss_curves.collect()
    for fold in (0, 1):
        mine = [r for r in curves if r.fold == fold]
        kept = [r.round for r in mine if r.kept]
        assert kept == [min(mine, key=lambda r: (r.loss, r.round)).round] == [run.iterations[fold]]


def test_forest_votes_out_of_bag(spark, rows):
    report = Report()
    model = fit("RandomForestClassifier", {"n_estimators": 6, "max_depth": 5, "oob_score": True,
                                           "class_weight": "balanced", "random_state": 5}, rows,
                report=report)
    assert not report.skipped
    out = model.out_of_bag(rows, "vote").collect()
    import hashlib
    for r in out:
        u = [int(hashlib.md5(f"{r.key}|{5 + i}".encode()).hexdigest()[:8], 16) / 2 ** 32
             for i in range(6)]
        assert r.vote_trees == sum(x < math.exp(-1) for x in u)
        assert (r.vote is None) == (r.vote_trees == 0)
        assert r.vote is None or 0 <= r.vote <= 1
    one = fit("RandomForestClassifier", {"n_estimators": 1, "max_depth": 5, "oob_score": True,
                                         "random_state": 5}, rows)
    by_key = {r.key: r.proba for r in one.predict(rows, "proba").collect()}
    assert all(r.vote == pytest.approx(by_key[r.key])
               for r in one.out_of_bag(rows, "vote").collect() if r.vote_trees)
    mean = model.predict(rows, "proba")
    assert auc(mean) > 0.8 and len(model.importances) == 8


def test_extra_trees_split_at_random_thresholds(rows):
    cuts = random_thresholds(rows, "features", 2, 7, 4).collect()
    x = np.array([r.features.toArray() for r in rows.collect()])
    low, high = x.min(0), x.max(0)
    assert len(cuts) == 2 * 8 * 4
    assert all(low[r.feature] <= r.cut <= high[r.feature] for r in cuts)
    held = F.col("key") % 4 == 0
    params = {"n_estimators": 12, "max_depth": 6, "random_state": 7}
    extra = fit("ExtraTreesClassifier", params, rows.where(~held))
    forest = fit("RandomForestClassifier", params, rows.where(~held))
    scored = extra.predict(rows.where(held), "proba")
    assert scored.columns == [*rows.columns, "proba"]
    assert auc(scored) > auc(forest.predict(rows.where(held), "proba")) - 0.1
    assert sum(extra.importances) == pytest.approx(1)
    flat = rows.withColumn("features", array_to_vector(F.array(F.lit(1.0), F.lit(2.0))))
    assert fit("ExtraTreesClassifier", params, flat).predict(flat, "proba").select(
        "proba").distinct().count() == 1


def test_modified_huber_reaches_the_minimum(spark, rows):
    for ratio in (0.0, 0.5, 1.0):
        model = fit_modified_huber(rows, "features", "label", alpha=0.01, l1_ratio=ratio)
        assert all(a > b for a, b in zip(model.objectives, model.objectives[1:], strict=False))
        assert model.residual < 1e-6
        x = np.array([[*r.features.toArray(), 1.0] for r in rows.collect()])
        y = np.array([2 * r.label - 1 for r in rows.collect()])

        def gradient(w):
            z = y * (x @ w)
            slope = np.where(z >= 1, 0, np.where(z >= -1, -2 * (1 - z), -4)) * y
            return (slope @ x) / len(y)
        assert optimality(model.weights, gradient(model.weights), 0.01 * ratio,
                          0.01 * (1 - ratio)) < 1e-5
    fitted = fit("SGDClassifier", {"loss": "modified_huber", "alpha": 0.001, "l1_ratio": 0.15,
                                   "class_weight": "balanced"}, rows)
    scored = fitted.predict(rows, "proba")
    logistic = fit("SGDClassifier", {"loss": "log", "alpha": 0.001, "l1_ratio": 0.15,
                                     "class_weight": "balanced"}, rows).predict(rows, "proba")
    assert scored.where("proba between 0 and 1").count() == rows.count()
    assert auc(scored) > auc(logistic) - 0.02
    empty = fit_modified_huber(rows.limit(0), "features", "label")
    assert empty.weights.tolist() == [0.0]
    alike = fit_modified_huber(rows.withColumn("label", F.lit(1)), "features", "label")
    assert alike.predict(rows, "features", "p").select(F.min("p")).first()[0] > 0.99


def test_modified_huber_sums_and_reports(rows):
    loss, gradient, curvature = _pass(
        rows.selectExpr("array(2.0D) as x", "1.0D as y", "1.0D as share").limit(1),
        np.array([-1.0, 0.0]))
    assert (loss, gradient.tolist(), curvature.tolist()) == (8.0, [-8.0, -4.0], [[0, 0], [0, 0]])
    report = Report()
    fit("SGDClassifier", {"loss": "hinge", "penalty": "elasticnet", "max_iter": 2}, rows,
        report=report)
    assert any("loss" in str(s) for s in report.skipped)


def test_stored_rows_go_to_asking_chunks_only(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 100, (6, 3))
    x = np.concatenate([c + rng.normal(0, 1, (60, 3)) for c in centres])
    data = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                                 "key long, features array<double>")
    t = _vectors(data, "key", "features")
    asked, held = routes(t, t, 4, 1, 20, 16, 40, 0)
    pairs = asked.select("cell", "block", "chunk").distinct()
    stored = {}
    for r in held.collect():
        stored.setdefault((r.cell, r.block), {}).setdefault(r.chunk, []).append(r.key)
    assert {(c, b, k) for (c, b), ks in stored.items() for k in ks} <= {
        tuple(r) for r in pairs.collect()}
    assert all(len({tuple(sorted(v)) for v in ks.values()}) == 1 for ks in stored.values())
    copies, chunks = held.count(), asked.select("chunk").distinct().count()
    assert chunks >= 9 and copies < 0.5 * len(x) * chunks
    got = {}
    for r in nearest_rows(data, data, "key", "features", 3, exclude_self=True, pivots=20,
                          block_rows=16, chunk_rows=40).collect():
        got.setdefault(r.key, []).append((r.distance, r.neighbour))
    for i in range(len(x)):
        d = np.abs(x - x[i]).sum(1)
        want = sorted((d[j], j) for j in range(len(x)) if j != i)[:3]
        assert [n for _, n in sorted(got[i])] == [j for _, j in want]
