"""Model runs: no leakage, each key once, quality floors, neighbours against brute force."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from featherloom.ml import neighbours
from featherloom.ml.matrix import materialise
from featherloom.ml.models import fit, oof_predict, refit_full
from featherloom.ml.neighbours import Cells, _vectors, knn_votes, nearest_rows, routes
from featherloom.ml.reduce import decompose
from featherloom.ml.search import cross_val_score, integer, real, sample_trials, search
from featherloom.ml.stack import fit_stacker, resolve_model, stack_meta_inputs
from featherloom.operators.metrics import roc_auc
from featherloom.operators.splits import stratified_kfold
from featherloom.queries import fixtures as fx
from featherloom.report import Report
from featherloom.sources.store import load_params, shared_folder


@pytest.fixture(scope="module")
def data(spark, folder):
    rows = fx.vectors(spark, folder).select(
        F.col("vec_id").alias("key"), "label", array_to_vector("x").alias("features"))
    return materialise(stratified_kfold(rows, "key", "label", 3))


def auc(df, score="proba"):
    return roc_auc(df, score, "label").first()["auc"]


@pytest.mark.parametrize("model,params", [
    ("LGBMClassifier", {"n_estimators": 3, "max_depth": 3, "scale_pos_weight": 2}),
    ("ExtraTreesClassifier", {"n_estimators": 5, "max_depth": 4, "class_weight": "balanced"}),
    ("XGBClassifier", {"booster": "gblinear", "reg_alpha": 0.001, "reg_lambda": 0.01}),
    ("GaussianNB", {}),
    ("KNeighborsClassifier", {"n_neighbors": 5, "weights": "distance", "p": 1}),
    ("BaggingClassifier", {"n_estimators": 2, "max_features": 0.8, "base_estimator": {
        "model": "SGDClassifier", "params": {"max_iter": 5}}})])
def test_models_learn(data, model, params):
    assert auc(fit(model, params, data).predict(data, "proba")) > 0.6


def test_out_of_fold_covers_every_key_once_and_does_not_leak(data):
    train, test = data.filter("key % 4 > 0"), data.filter("key % 4 = 0")
    run = oof_predict(train, "LGBMClassifier", {"n_estimators": 3, "max_depth": 3}, 3, test)
    oof = run.train_oof
    assert oof.count() == train.count() == oof.select("key").distinct().count()
    assert run.test_oof.count() == test.count()
    assert run.importances.select("fold").distinct().count() == 3
    assert set(run.bundle()) == {"train_oof", "test_oof", "feature_importance"}
    full = refit_full(train, test, "LGBMClassifier", {"max_depth": 3}, run.iterations)
    assert full.count() == test.count() and run.iterations == [3, 3, 3]
    # a label that is pure noise per key can only be predicted by leaking it
    noise = train.withColumn("label", (F.xxhash64("key") % 2 == 0).cast("int"))
    noisy = oof_predict(noise, "RandomForestClassifier", {"n_estimators": 5}, 3).train_oof
    assert auc(noisy) < 0.65


def test_early_stopping_keeps_fewer_trees(data):
    noise = data.withColumn("label", (F.xxhash64("key") % 2 == 0).cast("int"))
    run = oof_predict(noise, "LGBMClassifier", {"n_estimators": 12, "max_depth": 3,
                                                "validation_tol": 0.01}, 3, early_stopping=True)
    assert min(run.iterations) < 12


def test_ignored_parameters_are_reported(data):
    report = Report()
    fit("RandomForestClassifier", {"n_estimators": 2, "warm_start": True, "n_jobs": -1}, data,
        report=report)
    assert report.names("fit") == ["random_forest.warm_start"]


@pytest.mark.parametrize("p,block", [(1, 8192), (2, 16)])
def test_neighbours_equal_brute_force(spark, folder, p, block):
    table = fx.vectors(spark, folder).select("vec_id", "label", "x")
    copies = table.filter("vec_id < 5").withColumn("vec_id", F.col("vec_id") + 100000)
    table = table.union(copies).cache()
    got = nearest_rows(table, table, "vec_id", "x", 4, p, exclude_self=True, pivots=8,
                       block_rows=block, chunk_rows=50)
    rows = table.orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["x"] for r in rows])
    want = {}
    for i, key in enumerate(ids):
        gap = np.abs(x - x[i])
        d = gap.sum(axis=1) if p == 1 else np.sqrt((gap ** 2).sum(axis=1))
        d[i] = np.inf
        want[key] = ids[np.argsort(np.round(d, 9), kind="stable")[:4]].tolist()
    found = {}
    for r in got.orderBy("key", F.round("distance", 9), "neighbour").collect():
        found.setdefault(r["key"], []).append(r["neighbour"])
    assert found == want
    votes = knn_votes(table, table, "vec_id", "x", "label", 4, p, exclude_self=True)
    assert votes.groupBy("vec_id").agg(F.abs(F.sum("proba") - 1).alias("e")).filter(
        "e > 1e-9").count() == 0


def test_queries_ask_blocks_not_cells(spark):
    # no cell can be ruled out: each query used to be sent to all 64 of them
    x = np.random.default_rng(0).normal(size=(600, 16))
    t = _vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                                       "key long, features array<double>"), "key", "features")
    asked, held = routes(t, t, 5, 1, 64, 8192, 8192, 0)
    assert asked.count() == 600
    assert held.count() == 600 * asked.select("chunk").distinct().count()


@pytest.mark.parametrize("p", [1, 2, 3])
@pytest.mark.parametrize("case", ["plain", "scales", "far", "ties", "outliers"])
def test_closest_rows_in_a_block(monkeypatch, case, p):
    rng = np.random.default_rng(3)
    y = rng.normal(size=(3000, 6))
    if case == "scales":
        y *= [1e6, 1, 1e-6, 1, 1, 0]
    elif case == "far":
        y += 1e9
    elif case == "ties":
        y = np.round(y)
    elif case == "outliers":
        y[::50] *= 1e200
    x = y[:300]
    cells = Cells(y[:40], p)
    home, far, _, top = cells.home(y)
    used = np.unique(home)
    cells.measured(used, np.bincount(home)[used],
                   *(np.array([v[home == c].max() for c in used]) for v in (far, top)))
    paired, exact = neighbours._paired, []
    monkeypatch.setattr(neighbours, "_paired",
                        lambda *a: exact.append(len(a[1])) or paired(*a))
    with np.errstate(over="ignore", invalid="ignore"):
        i, j, d = neighbours._closest(x, np.full(300, np.inf), y, home, cells,
                                      lambda a, b: a == b, 5, 6)
        want = neighbours._distances(x, y, p)
    want[np.arange(300), np.arange(300)] = np.nan
    best = np.argsort(want, axis=1, kind="stable")[:, :5]
    assert (i == np.repeat(np.arange(300), 5)).all() and (j == best.ravel()).all()
    assert (d == want[i, j]).all()
    if case == "plain" and p == 1:
        assert sum(exact) < 0.1 * want.size


def test_rows_of_a_repeated_key_do_not_hide_neighbours(spark):
    rows = [(1, [i / 100]) for i in range(9)] + [(k, [100.0 * k]) for k in range(2, 30)]
    df = spark.createDataFrame(rows, "key long, features array<double>")
    out = nearest_rows(df, df, "key", "features", 2, exclude_self=True, pivots=40, block_rows=2)
    assert {r.neighbour for r in out.collect() if r.key == 1} == {2}


def test_svd_and_pca_match_numpy(spark, folder):
    rows = fx.vectors(spark, folder).select(
        "vec_id", *[F.col("x")[i].alias(f"dim{i}") for i in range(6)])
    methods = {"S": {"object": "TruncatedSVD", "params": {"n_components": 3}},
               "P": {"object": "IncrementalPCA", "params": {"n_components": 2}},
               "N": {"object": "NMF", "params": {"n_components": 2, "max_iter": 3}},
               "L": {"object": "LatentDirichletAllocation",
                     "params": {"n_components": 2, "max_iter": 2}},
               "R": {"object": "SparseRandomProjection", "params": {"n_components": 2}},
               "Z": {"object": "Isomap"}}
    report = Report()
    out = decompose(rows, {"stems": ["dim"], "columns": ["absent"], "methods": methods},
                    report).orderBy("vec_id").toPandas()
    assert report.names("decompose") == ["absent", "Z"]
    x = out[[f"dim{i}" for i in range(6)]].to_numpy()
    vt = np.linalg.svd(x, full_matrices=False)[2]
    for i in range(3):
        np.testing.assert_allclose(np.abs(out[f"S_{i + 1}"]), np.abs(x @ vt[i]), atol=1e-6)
    centred = x - x.mean(axis=0)
    axes = np.linalg.svd(centred, full_matrices=False)[2]
    np.testing.assert_allclose(np.abs(out["P_1"]), np.abs(centred @ axes[0]), atol=1e-6)
    assert (out[["N_1", "N_2"]] >= 0).all(axis=None)
    np.testing.assert_allclose(out["L_1"] + out["L_2"], 1, atol=1e-6)


def test_search_narrows_and_stores_parameters(spark, data):
    space = {"alpha": real(1e-4, 1e-1, "log-uniform"), "max_iter": integer(3, 5)}
    drawn = sample_trials(spark.range(200).withColumnRenamed("id", "trial"), space)
    r = drawn.agg(F.min("alpha"), F.max("alpha"), F.min("max_iter"), F.max("max_iter")).first()
    assert r[0] >= 1e-4 and r[1] <= 1e-1 and (r[2], r[3]) == (3, 5)
    folder = shared_folder(spark)
    config = {"search_settings": {"n_calls": 2, "n_inits": 1},
              "evaluation_settings": {"nr_fold": 2}, "initialize": {"l1_ratio": 0.0},
              "search_space": space}
    params, trials = search(data, "T", "SGDClassifier", config, folder=folder)
    table = trials.orderBy("trial").collect()
    # the default metric is negative, and still the best trial is kept
    assert len(table) == 2 and table[-1]["best_score"] == max(t["score"] for t in table) < 0
    assert load_params(spark, folder, "T") == params and params["l1_ratio"] == 0.0
    assert load_params(spark, folder, "unknown") == {}
    ahead = cross_val_score(data, "GaussianNB", {}, {"validation": "TimeSeriesSplit",
                                                     "nr_fold": 2, "eval_metric": "roc_auc"})
    assert 0 < ahead < 1


def test_stacking(spark, data):
    rows = data.select("key", "label", *[vector_to_array("features")[i].alias(f"x{i}")
                                         for i in range(8)])
    train, test = rows.filter("key % 4 > 0"), rows.filter("key % 4 = 0")
    zoo = {"NB": {"model": "GaussianNB"}, "LR": {"model": "SGDClassifier", "task": "Tuned",
                                                 "params": {"max_iter": 3}},
           "Bag": {"model": "BaggingClassifier", "params": {"base_estimator": "LR"}}}
    assert resolve_model(zoo["LR"], zoo, {"Tuned": {"max_iter": 7}})[1] == {"max_iter": 7}
    assert resolve_model(zoo["Bag"], zoo)[1]["base_estimator"]["model"] == "SGDClassifier"
    out = fit_stacker(train, test, {"name": "S", "cv": 2, "use_features": True},
                      [resolve_model(zoo["NB"], zoo), resolve_model(zoo["LR"], zoo)],
                      ("SGDClassifier", {"max_iter": 5}), "key", "label",
                      [f"x{i}" for i in range(8)])
    assert out.train_meta.columns == ["key", "S_0", "S_1", "S_2", "S_3"]
    assert out.train_meta.count() == train.count() and out.test_pred.count() == test.count()
    assert set(out.base_auc) == {"base_0", "base_1"}
    inputs = stack_meta_inputs({"E": [], "F": [train.select("key", F.lit(.5).alias("proba"))]},
                               out.train_meta.select("key", "S_1"), train, "key")
    assert inputs.columns == ["key", "F", "S_1", "F_X_S_1"]
