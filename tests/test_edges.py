"""Missing-value rules and documented choices, on small hand-made tables."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from featherloom.naming import format_run_name, parse_run_name
from featherloom.operators.aggregate import aggregate, aggregate_specs
from featherloom.operators.clean import (
    drop_rows, nan_to_num, narrow_types, normalise_missing, replace_values)
from featherloom.operators.encode import (
    TooManyCategories, class_weights, discover_categories, factorize, one_hot)
from featherloom.operators.interact import interaction, pair_geometric, row_stats
from featherloom.operators.joins import align_aggregates, lookup_join, outer_align
from featherloom.operators.metrics import log_loss, roc_auc
from featherloom.operators.rank import exact_quantiles, pct_rank, running_best
from featherloom.operators.schema import align_columns, cull_features, select_by_stem
from featherloom.report import Report

INF = float("inf")


def values(df, *columns, order="i"):
    return [tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]]
            for r in df.orderBy(order).collect()]


def rows(spark, data, names):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(data)], f"i long, {names}")


def test_divide_by_zero_and_missing(spark):
    df = rows(spark, [(1., 0.), (None, 1.), (2., None), (0., 0.), (-1., 0.)], "a double, b double")
    out, made = interaction(df, [{"name": "r", "mode": "divide", "a": "a", "b": "b"}])
    assert made == ["r"]
    assert values(out, "r") == [INF, None, None, None, -INF]
    out, _ = interaction(df, [{"name": "r", "mode": "divide_nonzero", "a": "a", "b": "b"}])
    assert values(out, "r") == [1.0, None, None, 0.0, -1.0]


def test_subtract_positive_and_sum_squared(spark):
    df = rows(spark, [(1., 0.), (None, 1.), (2., None), (0., 0.), (INF, INF)],
              "a double, b double")
    out, _ = interaction(df, [
        {"name": "p", "mode": "subtract_positive", "a": "a", "b": "b"},
        {"name": "d", "mode": "subtract", "a": "a", "b": "b"}])
    assert values(out, "p") == [1, 0, 0, 0, 0]
    assert values(out, "d") == [1, None, None, 0, None]
    df = rows(spark, [(1., 2.), (None, 3.), (None, None)], "a double, b double")
    out, _ = interaction(df, [{"name": "s", "mode": "sum_squared", "a": "a", "b": "b"}])
    assert values(out, "s") == [5, 9, 0]


def test_interaction_reports_what_it_skips(spark):
    report = Report()
    df = rows(spark, [(1.,)], "a double")
    _, made = interaction(df, [{"name": "x", "mode": "power", "a": "a", "b": "a"},
                               {"name": "y", "mode": "add", "a": "a", "b": "zz"}], report)
    assert made == [] and report.names("interaction") == ["x", "y"]


def test_row_statistics_match_pandas(spark):
    data = [(1., 2., 4., 9.), (1., 1., 1., 1.), (1., 2., None, 3.), (0., 0., 0., 1.),
            (None, None, None, None), (5., None, None, None)]
    names = list("abcd")
    frame = pd.DataFrame(data, columns=names, dtype=float)
    df = rows(spark, data, "a double, b double, c double, d double")
    methods = ["kurtosis", "sum", "mean", "std", "product", "sum_squared"]
    out = row_stats(df, {"header": "H", "transform": methods, "columns": names})
    std = frame.std(axis=1)
    want = {"KURTOSIS": frame.kurtosis(axis=1), "SUM": frame.sum(axis=1),
            "MEAN": frame.mean(axis=1), "STD": std.fillna(std.mean()),
            "PRODUCT": frame.fillna(frame.mean()).product(axis=1),
            "SUM_SQUARED": frame.pow(2).sum(axis=1)}
    for method, expected in want.items():
        for got, exp in zip(values(out, f"H_{method}"), expected):
            assert (got is None and math.isnan(exp)) or got == pytest.approx(exp), method


def test_row_statistics_over_three_columns(spark):
    df = rows(spark, [(1., 2., 3.), (None, 4., None), (None, None, None)],
              "a double, b double, c double")
    out = row_stats(df, {"header": "H", "transform": ["mean", "sum", "product", "std"],
                         "columns": ["a", "b", "c"]})
    assert values(out, "H_MEAN") == [2, 4, None]
    assert values(out, "H_SUM") == [6, 4, 0]
    assert values(out, "H_PRODUCT") == [6, 12, 9]
    assert values(out, "H_STD") == [1, 1, 1]


def test_pair_geometric(spark):
    df = rows(spark, [(.25, 4.), (None, .5), (None, None), (-1., 1.)], "a double, b double")
    out = pair_geometric(df, ["a", "b"])
    assert values(out, "a_X_b") == pytest.approx([1, math.sqrt(.5), 1, 0])
    assert values(out, "a") == [.25, 0, 0, -1]


def test_group_rules(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (2, None), (2, None), (None, 5)],
                               "k int, v int")
    out = aggregate(df, "k", {"v": ["min", "max", "mean", "sum", "var", "size", "nunique",
                                    "count", "median"]}, header="H").orderBy("k").collect()
    assert [r["k"] for r in out] == [1, 2]
    assert list(out[0])[1:] == [1, 1, 1.0, 1, None, 2, 1, 1, 1.0]
    assert list(out[1])[1:] == [None, None, None, 0, None, 2, 0, 0, None]


def test_variance_over_infinity_is_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (1, INF)], "k int, v double")
    assert aggregate(df, "k", {"v": ["var"]}, header="H").first()["H_v_VAR"] is None


def test_category_functions_replace_numeric_ones(spark):
    df = spark.createDataFrame([(1, 1), (1, 0)], "k int, d int")
    out = aggregate(df, "k", {"d": ["mean", "sum"]}, ["d"], ["mean"], "H", count=True)
    assert out.columns == ["k", "H_d_MEAN", "H_COUNT_k"]


def test_count_only_and_empty_specs(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "k int, d int")
    assert {tuple(r) for r in aggregate(df, "k", header="H", count=True).collect()} == \
        {(1, 2), (2, 1)}
    assert {r["k"] for r in aggregate(df, "k").collect()} == {1, 2}
    with pytest.raises(ValueError):
        aggregate(df, "k", {"d": ["no_such"]})


SPECS = [
    {"header": "A", "groupby": ["k"], "num": {"v": ["sum", "size", "min"]}},
    {"header": "B", "groupby": ["k"], "num": {"v": ["sum", "nunique", "median"]}, "count": True,
     "subset": {"column_name": "c", "conditions": ["x"]}},
    {"header": "C", "groupby": ["k", "c"], "num": {"v": ["max"]}},
    {"header": "D", "groupby": ["k"], "num": {"v": ["sum"]},
     "subset": {"column_name": "absent", "conditions": [1]}},
    {"header": "E", "groupby": ["k"], "num": {"v": ["sum"]},
     "subset": {"column_name": "c", "conditions": ["none"]}}]


@pytest.mark.parametrize("align", ["inner", "left", "outer"])
def test_fused_specs_equal_separate_ones(spark, align):
    df = spark.createDataFrame(
        [(1, "x", 1), (1, "y", 2), (2, "y", 3), (3, "x", None), (3, "x", 7), (None, "x", 1)],
        "k int, c string, v int")
    report = Report()
    out = aggregate_specs(df, SPECS, align=align, report=report)
    assert report.names("aggregate") == ["D", "E"]
    assert set(out) == {("k",), ("c", "k")} or set(out) == {("k",), ("k", "c")}
    separate = [aggregate(df, "k", SPECS[0]["num"], header="A"),
                aggregate(df.filter("c = 'x'"), "k", SPECS[1]["num"], header="B", count=True)]
    want = align_aggregates(separate, "k", align)
    got = out[("k",)].select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_subset_conditions_keep_missing_rows(spark):
    df = rows(spark, [("XNA",), ("F",), (None,)], "c string")
    assert values(drop_rows(df, {"c": ["XNA"]}), "c") == ["F", None]
    assert values(drop_rows(df, {"c": [None]}), "c") == ["XNA", "F"]
    assert drop_rows(df, {}).count() == 3


def test_replace_and_normalise(spark):
    df = rows(spark, [(365243, "a", float("nan")), (5, None, 1.0)], "d int, s string, x double")
    out = replace_values(df, {"d": {365243: float("nan")}, "s": {None: "none"}, "zz": {1: 2}})
    assert values(out, "d", "s") == [(None, "a"), (5, "none")]
    assert values(normalise_missing(df), "x") == [None, 1.0]


def test_nan_to_num_and_narrow(spark):
    top = 1.7976931348623157e308
    df = rows(spark, [(None,), (INF,), (-INF,), (1.0,)], "x double")
    assert values(nan_to_num(df, ["x"]), "x") == [0, top, -top, 1]
    report = Report()
    wide = spark.createDataFrame([(1, 2147483653, 7, 0.5)], "k long, w long, s long, x double")
    out = narrow_types(wide, ["k"], report=report)
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "bigint", "int", "float"]
    assert out.first()["w"] == 2147483653 and report.names("narrow_types") == ["w"]


def test_encoders(spark):
    df = rows(spark, [("x",), (None,), ("y",), ("x",)], "c string")
    out, made, sources = one_hot(df)
    assert made == ["c_x", "c_y", "c_nan"] and sources == ["c"]
    assert values(out, *made) == [(1, 0, 0), (0, 0, 1), (0, 1, 0), (1, 0, 0)]
    assert values(factorize(df, ["c"], "i"), "c") == [0, -1, 1, 0]
    with pytest.raises(TooManyCategories):
        discover_categories(df, ["c"], limit=1)
    weighted = class_weights(rows(spark, [(0,), (0,), (0,), (1,), (None,)], "y int"), "y", "w")
    assert values(weighted, "w") == pytest.approx([4 / 6, 4 / 6, 4 / 6, 2, None])


def test_ranks_and_quantiles(spark):
    df = rows(spark, [(1.,), (2.,), (2.,), (9.,), (None,)], "x double")
    assert values(pct_rank(df, ["x"], "_pct"), "x_pct") == [.25, .625, .625, 1, None]
    series = pd.Series([3., 1., 4., 1., 5., 9., 2., 6.])
    table = spark.createDataFrame([(v,) for v in series], "x double")
    got = exact_quantiles(table, "x", [.1, .25, .5, .8])
    assert list(got.first()) == pytest.approx(series.quantile([.1, .25, .5, .8]).tolist())
    best = running_best(rows(spark, [(-3.,), (-1.,), (-2.,), (0.,)], "s double"), "s", "i", "b")
    assert values(best, "b") == [-3, -1, -1, 0]


def test_metrics(spark):
    df = spark.createDataFrame([(.1, 0), (.4, 0), (.35, 1), (.8, 1)], "s double, y int")
    assert roc_auc(df, "s", "y").first()["auc"] == 0.75
    want = -sum(math.log(p) for p in (.9, .6, .35, .8)) / 4
    assert log_loss(df, "s", "y").first()["log_loss"] == pytest.approx(want)
    one_class = df.filter("y = 1")
    assert roc_auc(one_class, "s", "y").first()["auc"] is None


def test_auc_equals_pair_count(spark):
    data = [((i * 37 % 11) / 10, int(i * 13 % 7 < 3), i % 2) for i in range(120)]
    df = spark.createDataFrame(data, "s double, y int, g int")
    for r in roc_auc(df, "s", "y", ["g"]).collect():
        pos = [s for s, y, g in data if g == r["g"] and y == 1]
        neg = [s for s, y, g in data if g == r["g"] and y == 0]
        wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
        assert r["auc"] == pytest.approx(wins / (len(pos) * len(neg)))


def test_alignment(spark):
    a = spark.createDataFrame([(1, 1), (2, 2)], "k int, a int")
    b = spark.createDataFrame([(2, 5)], "k int, b int")
    assert {r["k"] for r in align_aggregates([a, b], "k").collect()} == {2}
    assert {r["k"] for r in align_aggregates([a, b], "k", "left").collect()} == {1, 2}
    assert {tuple(r) for r in outer_align([b, a], "k").select("k", "a", "b").collect()} == \
        {(1, 1, None), (2, 2, 5)}


def test_lookup_join_with_hot_and_missing_keys(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else str(i)) for i in range(3000)]
                               + [(9999, None)], "i long, v string")
    table = df.filter("v is not null").groupBy("v").agg(F.count("*").alias("n"),
                                                        F.min("i").alias("first"))
    got = lookup_join(df, table, "v", "n")
    assert got.count() == 3001
    wrong = got.filter("v = 'hot' and first <> 1 or v <> 'hot' and first <> i "
                       "or v is null and first is not null")
    assert wrong.count() == 0


def test_column_lists(spark):
    df = spark.createDataFrame([(1, 2, 3)], "k int, b_x int, a int")
    other = spark.createDataFrame([(1, 2)], "k int, a int").withColumn("t", F.lit(0))
    left, right = align_columns(df.withColumn("t", F.lit(1)), other, "t", ["k"])
    assert left.columns == right.columns == ["k", "a", "t"]
    assert cull_features(df, []).columns == df.columns
    assert cull_features(df, ["a", "zz"]).columns == ["k", "b_x"]
    assert select_by_stem(df, ["b_"], ["a", "b_x"]) == ["a", "b_x"]


def test_names_with_dots_and_spaces(spark):
    df = rows(spark, [("a.b c",), ("`q`",)], "c string")
    out, made, _ = one_hot(df)
    summed = aggregate(out, "i", cat_cols=made, cat=["sum"], header="H")
    assert set(summed.columns) == {"i", "H_c_a.b c_SUM", "H_c_`q`_SUM", "H_c_nan_SUM"}
    assert summed.count() == 2


def test_run_name_round_trip(spark):
    df = spark.sql("select 1 as l, 'my_xgb' as m, 531 as f, 0.79357D as s, 5 as n, "
                   "timestamp'2018-08-30 00:14:00' as t")
    name = format_run_name(F.col("l"), F.col("m"), F.col("f"), F.col("s"), F.col("n"), F.col("t"))
    text = df.select(name.alias("x")).first()["x"]
    assert text == "level[1]_my_xgb_features[0531]_score[0.793570]_fold[5]_2018-08-30-00-14"
    wrapped = df.select(F.concat(F.lit("subm_"), name, F.lit(".csv")).alias("x"))
    parts = wrapped.select(*[c.alias(n) for n, c in parse_run_name(F.col("x")).items()]).first()
    assert list(parts)[:5] == [1, "my_xgb", 531, 0.79357, 5]
    assert str(parts["timestamp"]) == "2018-08-30 00:14:00"


def test_carried_categories_by_whole_names(spark):
    from featherloom.operators.aggregate import carried_categories
    df = spark.createDataFrame([(1, 2.0, 3.0, 4.0)], "k long, H_A_1_MEAN double, "
                                                     "H_A_10_MEAN double, H_BA_1_MEAN double")
    assert carried_categories(df, ["A_1"]) == ["H_A_1_MEAN"]
