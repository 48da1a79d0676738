"""Nothing is cut, lost or merged without a report."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from featherloom.ml import reduce
from featherloom.ml.models import MAX_DEPTH, _poisson_count, _translate
from featherloom.ml.neighbours import nearest_rows
from featherloom.operators.encode import one_hot
from featherloom.operators.joins import outer_align
from featherloom.operators.splits import kfold
from featherloom.plans.build import build_history
from featherloom.report import Report


@pytest.mark.parametrize(("given", "depth", "entries"), [(-1, MAX_DEPTH, 1), (None, MAX_DEPTH, 1),
                                                         (99, MAX_DEPTH, 1), (7, 7, 0), (0, 0, 0)])
def test_depth_without_limit_is_the_deepest_and_reported(given, depth, entries):
    report = Report()
    assert _translate("random_forest", {"max_depth": given}, report)["maxDepth"] == depth
    assert len(report.skipped) == entries


def test_poisson_counts_have_no_cap(spark):
    u = [0.0, 0.5, 1 - 1e-9, 1 - 1e-13, math.nextafter(1.0, 0)]
    got = [r.n for r in spark.createDataFrame([(x,) for x in u], "u double")
           .select(_poisson_count(F.col("u"), 1.0).alias("n")).collect()]
    assert got[0] == 0 and got[2] > 10 and got[-1] > got[2] and got == sorted(got)
    big = spark.createDataFrame([(0.5,)], "u double").select(_poisson_count(F.col("u"), 40.0)
                                                             .alias("n")).first().n
    assert 38 <= big <= 41


def test_missing_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c"), (4, "d")], "key long, v string")
    assert kfold(df, "key", 2).count() == 4


def test_outer_align_refuses_equal_names(spark):
    a = spark.createDataFrame([(1, 1.0)], "k long, x double")
    with pytest.raises(ValueError, match="x"):
        outer_align([a, a], "k")


def test_text_nan_and_missing_value_stay_apart(spark):
    df = spark.createDataFrame([("nan",), (None,), ("b",)], "c string")
    out, names, _ = one_hot(df, ["c"])
    assert names == ["c_b", "c_nan", "c_null"]
    assert sorted(tuple(r) for r in out.collect()) == [(0, 0, 1), (0, 1, 0), (1, 0, 0)]


def test_history_reports_other_keys_and_absent_aggregates(spark):
    rows = spark.createDataFrame([(1, 5, 2.0), (1, 6, 3.0), (None, 6, 1.0)],
                                 "k long, other long, v double")

    report = Report()
    out = build_history({"h": rows}, {"aggregations": []}, "h", "k", report)
    assert [tuple(r) for r in out.collect()] == [(1,)] and report.names("build_history") == ["h"]



def test_neighbours_with_missing_and_infinite_coordinates(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [None, 1.0]), (3, [float("nan"), 3.0]),
                                (4, [float("inf"), 0.0])], "key long, features array<double>")
    out = nearest_rows(df, df, "key", "features", 3, exclude_self=True).collect()
    assert len(out) == 12
    assert {(r.key, r.neighbour): r.distance for r in out}[1, 3] == 3.0


@pytest.mark.parametrize("p", [1, 2])
def test_neighbours_whose_distance_to_the_pivots_overflows(spark, p):
    inf = float("inf")
    rows = [(i, [float(i), 0.0]) for i in range(6)] + [(6, [inf, inf]), (7, [inf, inf])]
    df = spark.createDataFrame(rows, "key long, features array<double>")
    out = nearest_rows(df, df, "key", "features", 1, p=p, exclude_self=True, pivots=1).collect()
    assert len(out) == 8
    assert {r.key: (r.neighbour, r.distance) for r in out if r.key > 5} == {6: (7, 0.0), 7: (6, 0.0)}


def test_topics_of_every_row(spark):
    rows = [(i, float(i % 3 == 0), float(i % 3 == 1), 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double")
    out = reduce.lda(df, ["a", "b", "c"], "t", {"n_components": 2, "max_iter": 2})
    sums = np.array([sum(r[c] for c in out.columns if c.startswith("t_")) for r in out.collect()])
    assert len(sums) == 60 and np.allclose(sums, 1)


def test_each_row_moves_the_topics(spark):
    rows = np.random.default_rng(0).integers(1, 9, (8, 4)).astype(float)

    def mixtures(x):
        df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)],
                                   "k long, a double, b double, c double, d double").coalesce(1)
        out = reduce.lda(df, list("abcd"), "t", {"n_components": 2, "max_iter": 1})
        return {r.k: r.t_1 for r in out.collect()}

    before = mixtures(rows)
    for i in range(len(rows)):
        changed = rows.copy()
        changed[i] = changed[i][::-1] * [1, 5, 2, 9]
        after = mixtures(changed)
        assert max(abs(after[j] - before[j]) for j in before if j != i) > 1e-7, i


def test_topics_with_columns_and_rows_of_nothing(spark):
    rows = [(1, 2.0, 0.0, 1.0), (2, 0.0, 0.0, 3.0), (3, 0.0, 0.0, 0.0), (4, 5.0, -1.0, None)]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double")
    for frame, n in ((df, 4), (df.where("k = 3"), 1)):
        out = reduce.lda(frame, ["a", "b", "c"], "t", {"n_components": 2, "max_iter": 2}).collect()
        assert len(out) == n and np.allclose([r.t_1 + r.t_2 for r in out], 1)
