"""Ranks, codes and splits of many columns in one pass; sparse shares; culling by runs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featherloom.ml.reduce import decompose, gram
from featherloom.ml.runs import cull_by_runs
from featherloom.operators.encode import category_shares, factorize, share_of
from featherloom.operators.rank import pct_rank, running_best
from featherloom.operators.splits import shuffle_split, stratified_shuffle_split
from featherloom.report import Report
from featherloom.sources.store import write_store


def scans(df):
    """Reads of the test's own table in the planned query."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum("Relation" in line and "marker_column" in line for line in plan.splitlines())


def test_factorize_reads_its_table_twice_whatever_the_columns(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, rng.choice("abc") if i % 7 else None, rng.choice([0.0, -0.0, 1.5, None]),
             i % 3 == 0, rng.choice("xy"), i) for i in range(500)]
    spark.createDataFrame(rows, "k long, s string, d double, b boolean, t string, "
                                "marker_column long").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    out = factorize(df, ["s", "d", "b", "t", "absent"], "k")
    assert scans(out) == 1   # besides the pass that counted all columns
    got = {r.k: r for r in out.collect()}
    for j, c in ((1, "s"), (2, "d"), (3, "b"), (4, "t")):
        codes = {}
        for r in rows:
            if r[j] is not None:
                codes.setdefault(r[j], len(codes))
        assert [got[r[0]][c] for r in rows] == [codes.get(r[j], -1) if r[j] is not None else -1
                                                for r in rows]
    assert factorize(df, ["absent"], "k").columns == df.columns


def test_ranks_of_columns_of_several_types(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([1.0, 2.5, float("nan"), None, float("inf")]), rng.randint(0, 9),
             rng.choice(["a", "b", None]), 5.0) for i in range(300)]
    df = spark.createDataFrame(rows, "key long, a double, column long, value string, e double")
    assert scans(df) == 0
    got = {r.key: r for r in pct_rank(df, ["a", "column", "value", "e"], "_r").collect()}
    for j, c in ((1, "a"), (2, "column"), (3, "value"), (4, "e")):
        values = [r[j] for r in rows if r[j] is not None and r[j] == r[j]]
        for r in rows:
            want = None
            if r[j] is not None and r[j] == r[j]:
                below, same = sum(v < r[j] for v in values), values.count(r[j])
                want = (below + (same + 1) / 2) / len(values)
            assert got[r[0]][f"{c}_r"] == (want if want is None else pytest.approx(want))


@pytest.mark.parametrize("by", [None, "t"])
def test_splits_plan_alike_for_any_number(spark, by):
    rows = [(i // 2 if i < 20 else i, i % 3 if i % 5 else None) for i in range(200)] + [(None, 1)]
    df = spark.createDataFrame(rows, "k long, t long")

    def split(n):
        if by:
            return stratified_shuffle_split(df, "k", by, n, 0.25)
        return shuffle_split(df, "k", n, 0.25, 0.5)

    def exchanges(d):
        return d._jdf.queryExecution().executedPlan().toString().count("Exchange")
    assert exchanges(split(2)) == exchanges(split(7))
    out = split(3).collect()
    assert len(out) == len(rows)
    for i in range(3):
        for group in ({r.t for r in out} if by else {None}):
            mine = [r[f"split_{i}"] for r in out if not by or r.t == group]
            assert mine.count("valid") == -(-len(mine) // 4)
            if not by:
                assert mine.count("train") == len(mine) // 2


def test_shares_of_thousands_of_values(spark):
    rows = [(i % 3, i if i % 10 else None) for i in range(9000)] + [(None, 1)]
    df = spark.createDataFrame(rows, "k long, v long")
    out = category_shares(df, ["k"], "v").withColumn("one", share_of(F.col("shares"), "4")) \
        .withColumn("gone", share_of(F.col("shares"), "nan")).collect()
    assert sorted(r.k for r in out) == [0, 1, 2]
    for r in out:
        assert len(r.shares) == 2701 and sum(r.shares.values()) == pytest.approx(1)
        assert r.one == pytest.approx(1 / 3000 if r.k == 1 else 0) and r.gone == pytest.approx(0.1)
    assert category_shares(df.limit(0), ["k"], "v").count() == 0


def test_gram_and_axes(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(3, 1, (300, 5)) @ rng.normal(0, 1, (5, 5))
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)],
                               "k long, " + ", ".join(f"c{j} double" for j in range(5)))
    arrays = df.select(F.array(*[f"c{j}" for j in range(5)]).alias("x"))
    for r in gram(arrays, "x", 5).collect():
        assert r.value == pytest.approx((x.T @ x)[r.i, r.j])
    spec = {"stems": ["c"], "methods": {"S": {"object": "TruncatedSVD", "params":
                                             {"n_components": 5}},
                                        "P": {"object": "PCA", "params": {"n_components": 2}}}}
    out = decompose(df, spec, available=df.columns).orderBy("k").collect()
    s = np.array([[r[f"S_{j}"] for j in range(1, 6)] for r in out])
    assert np.allclose(s @ s.T, x @ x.T)          # all components keep all products
    assert np.allclose(np.linalg.norm(s, axis=0), np.linalg.svd(x)[1])
    p = np.array([[r.P_1, r.P_2] for r in out])
    centred = x - x.mean(0)
    assert np.allclose(np.linalg.norm(p, axis=0), np.linalg.svd(centred)[1][:2])


def test_culling_by_runs(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0, 3.0, 4.0)], "key long, a double, `b.c` double, d double")
    for i, rows in enumerate(([("a", 6.0), ("b.c", 4.0), ("z", 0.0)], [("a", 5.0), ("b.c", 6.0)])):
        write_store(spark, f"{tmp_path}/r{i}", {"feature_importance": spark.createDataFrame(
            rows, "feature string, importance double")})
    report = Report()
    out, gone = cull_by_runs(df, str(tmp_path), ["r0", "r1", "none"], keep=["key"], report=report)
    assert (gone, out.columns) == (["b.c"], ["key", "a", "d"])
    assert report.names("stored_importances") == ["none"]
    assert cull_by_runs(df, str(tmp_path), [])[1] == []


def test_running_best_of_a_frequent_order_value(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", None]), rng.choice([None, float("nan"), 0.0, -0.0, 5.0, *range(9)])
             if i % 3 else 4.0, rng.choice([None, float(i % 50)]), i) for i in range(900)]
    rows = [(g, None if o is None else float(o), s, i) for g, o, s, i in rows]
    df = spark.createDataFrame(rows, "g string, o double, s double, i long")
    out = running_best(df, "s", "o", "best", ["g"])
    assert out.columns == ["g", "o", "s", "i", "best"]
    got = {r.i: r.best for r in out.collect()}

    def place(o):
        return float("-inf") if o is None or o != o else o
    for g, o, _, i in rows:
        seen = [s for h, p, s, _ in rows if h == g and place(p) <= place(o) and s is not None]
        assert got[i] == max(seen, default=None)
    assert running_best(df.limit(0), "s", "o", "best").count() == 0


def test_rows_of_one_order_value_stay_apart(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        df = spark.range(0, 8000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("o"),
            F.col("id").alias("s"))
        out = running_best(df, "s", "o", "best")
        hot = out.where("o = 7").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in hot) < 0.6 * sum(r["count"] for r in hot)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        spark.conf.set("spark.sql.adaptive.enabled", True)
