"""Runs on disk, and order columns of any type."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from featherloom.ml.models import OutOfFold
from featherloom.ml.runs import latest_meta, load_external, produce_oof, write_stack
from featherloom.ml.search import search_models
from featherloom.ml.stack import fit_stacker, stack_meta_inputs
from featherloom.operators.encode import class_weights, factorize
from featherloom.operators.joins import lookup_join
from featherloom.operators.rank import exact_quantiles, pct_rank, running_best
from featherloom.report import Report
from featherloom.sources.store import (
    any_empty, read_store, shared_folder, stored_names, write_store)

TIME = datetime(2020, 1, 2, 3, 4)


def _rows(spark):
    return spark.range(240).select(
        F.col("id").alias("key"), (F.col("id") % 2).cast("int").alias("label"),
        (F.col("id") % 2 + F.col("id") % 5 * 0.3).alias("x"),
        (F.col("id") % 7).cast("double").alias("y"))


def test_bundles_feed_the_second_level(spark):
    rows, folder = _rows(spark), shared_folder(spark)
    train, test = rows.where("key < 160"), rows.where("key >= 160").drop("label")
    names = produce_oof(train, test, "GaussianNB", {}, folder, "key", "label", drop=["y"],
                        n_folds=2, early_stopping=False, time=TIME)
    assert len(names) == 2 and all("_features[0001]_" in n and "_fold[2]_2020-01-02-03-04" in n
                                   for n in names)
    report = Report()
    external, unseen = load_external(spark, folder, {"A": names, "B": ["absent"]}, report)
    assert len(external["A"]) == 2 and external["B"] == [] and len(report.skipped) == 1
    assert external["A"][0].count() == 160 and unseen["A"][1].count() == 80
    full = read_store(spark, f"{folder}/{names[0].replace('[', '(').replace(']', ')')}")
    assert full["test_full"].count() == 80
    stacked = fit_stacker(train, test, {"name": "S", "cv": 2}, [("GaussianNB", {})],
                          ("SGDClassifier", {"max_iter": 3}), "key", "label", ["x", "y"])
    written = write_stack(spark, folder, "p", {"S": stacked}, "key", "label", train, 2, time=TIME)
    assert set(written) == {"S", "S_base0"}
    for run in written.values():
        path = f"{folder}/p_{run.replace('[', '(').replace(']', ')')}"
        assert spark.read.option("header", True).csv(path).count() == 80
    meta, meta_test = latest_meta(spark, folder, "p")
    assert meta.count() == 160 and meta_test.columns == ["key", "S_0", "S_1"]
    assert latest_meta(spark, folder, "other") == (None, None)
    inputs = stack_meta_inputs(external, meta.select("key", "S_1"), train, "key")
    assert inputs.count() == 160 and inputs.columns == ["key", "A", "S_1", "A_X_S_1"]


def test_interrupted_store_counts_as_missing(spark):
    path, rows = shared_folder(spark), _rows(spark)
    rows.write.parquet(f"{path}/main-x")
    assert stored_names(spark, path) == [] and any_empty(read_store(spark, path))
    assert write_store(spark, path, {"main": rows})
    assert write_store(spark, path, {"main": read_store(spark, path)["main"].where("key < 9")})
    assert read_store(spark, path)["main"].count() == 9


def test_order_columns_of_any_type(spark):
    rows = spark.createDataFrame(
        [(f"k,{i:03d}", Decimal(i % 5) / 4, i % 3 == 0, f"v{i % 7}", bytes([i % 4]))
         for i in range(90)],
        "k string, d decimal(20,2), b boolean, v string, z binary")
    ranks = {r["d"]: r["d_r"] for r in pct_rank(rows, ["d"], "_r").collect()}
    assert ranks == {Decimal(i) / 4: (18 * i + 9.5) / 90 for i in range(5)}
    codes = {r["k"]: r["v"] for r in factorize(rows, ["v"], "k").collect()}
    assert codes == {f"k,{i:03d}": i % 7 for i in range(90)}
    strings = {r["v"]: r["v_r"] for r in pct_rank(rows.select("v"), ["v"], "_r").collect()}
    assert sorted(strings, key=strings.get) == [f"v{i}" for i in range(7)]
    assert pct_rank(rows.select("b"), ["b"], "_r").where("b").first()["b_r"] == (60 + 15.5) / 90
    assert pct_rank(rows.select("z"), ["z"], "_r").distinct().count() == 4
    best = running_best(rows.withColumn("s", F.length("v")), "s", "k", "m")
    assert best.count() == 90
    inf = spark.createDataFrame([(1.0,), (float("inf"),), (float("inf"),)], "x double")
    assert exact_quantiles(inf, "x", [0.5, 0.0]).first()[:] == (float("inf"), 1.0)


def test_equal_hot_rows_spread_over_tasks(spark):
    rows = spark.range(0, 8000, 1, 16).select(F.lit("hot").alias("c")).unionByName(
        spark.range(0, 800, 1, 16).select(F.col("id").cast("string").alias("c")))
    table = rows.groupBy("c").agg(F.count(F.lit(1)).alias("n")).withColumn("code", F.length("c"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        out = lookup_join(rows, table, "c", "n")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count()
                 .collect()]
        assert sum(sizes) == 8800 and max(sizes) < 6000
        assert out.where("code is null").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        spark.conf.set("spark.sql.adaptive.enabled", True)


def test_class_weights_move_no_row(spark):
    out = class_weights(_rows(spark), "label")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r["class_weight"] for r in out.collect()} == {1.0}
    assert class_weights(_rows(spark).where("false"), "label").columns[-1] == "class_weight"


def test_bundle_names():
    assert set(OutOfFold(1, None, 2, []).bundle()) == {"train_oof", "feature_importance"}


def test_searches_that_all_fail_leave_no_trials(spark):
    rows = spark.createDataFrame([(i, i % 2) for i in range(8)], "key long, label int")
    report = Report()
    best, trials = search_models(rows, {"A": {"model": "NoSuchModel"}, "B": {}}, report=report)
    assert best == {} and trials is None
    assert report.names("search_models") == ["A", "B"]
