"""Results do not depend on partitioning; plans do not funnel rows into one task."""

import re

import pytest
from pyspark.sql import functions as F

from featherloom.operators.aggregate import aggregate_specs
from featherloom.operators.encode import factorize, one_hot
from featherloom.operators.joins import join_features, lookup_join
from featherloom.operators.rank import digest_row_number, ordered_row_number, pct_rank
from featherloom.operators.splits import (
    kfold, shuffle_split, stratified_kfold, time_series_fold, time_series_split)
from featherloom.operators.aggregate import aggregate
from featherloom.queries import QUERIES, fixtures as fx
from featherloom.queries.aggregations import order_specs


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    order = sorted(a.columns)
    return sorted(map(repr, a.select(order).collect())) == \
        sorted(map(repr, b.select(order).collect()))


OPERATORS = {
    "kfold": lambda d: kfold(d, "o_orderkey", 5),
    "stratified": lambda d: stratified_kfold(d, "o_orderkey", "status", 3),
    "pct_rank": lambda d: pct_rank(d, ["cents"]),
    "factorize": lambda d: factorize(d, ["status"], "o_orderkey"),
    "row_number": lambda d: ordered_row_number(d, "o_custkey", "o_orderkey", "rn"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_partitioning_and_row_order_do_not_matter(spark, folder, name):
    rows = fx.prev(spark, folder)
    want = OPERATORS[name](rows)
    for parts in (1, 5):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            got = OPERATORS[name](rows.repartition(parts + 1, F.rand(parts)))
            assert same(want, got)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_fold_sizes(spark, folder):
    rows = fx.prev(spark, folder)
    sizes = [r["count"] for r in kfold(rows, "o_orderkey", 7).groupBy("fold").count().collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1
    per = stratified_kfold(rows, "o_orderkey", "status", 4).groupBy("status", "fold").count()
    spread = per.groupBy("status").agg(F.max("count") - F.min("count"), F.sum("count"))
    assert all(r[1] <= 1 for r in spread.collect())
    assert sum(r[2] for r in spread.collect()) == rows.count()  # the missing class too


def test_shuffle_split_sizes(spark, folder):
    rows = fx.prev(spark, folder)
    n = rows.count()
    out = shuffle_split(rows, "o_orderkey", 2, 100, 200)
    for c in ("split_0", "split_1"):
        counts = {r[c]: r["count"] for r in out.groupBy(c).count().collect()}
        assert counts == {"valid": 100, "train": 200, None: n - 300}


def test_time_series_folds_never_look_ahead(spark, folder):
    rows = fx.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    out = time_series_split(rows, "o_orderkey", "o_orderdate", 4)
    n = rows.count()
    for i in range(1, 5):
        train, valid = time_series_fold(out, i)
        assert valid.count() == n // 5
        assert train.agg(F.max("o_orderdate")).first()[0] <= valid.agg(F.min("o_orderdate")).first()[0]


def test_one_frequent_value_still_gets_exact_row_numbers(spark):
    rows = spark.range(5000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id") % 200).cast("double").alias("v"))
    out = ordered_row_number(rows, "v", "id", "rn", buckets=16).orderBy("rn").collect()
    assert [r["rn"] for r in out] == list(range(1, 5001))
    values = [r["v"] for r in out]
    known = [v for v in values if v is not None]
    assert values[:len(values) - len(known)] == [None] * (len(values) - len(known))
    assert known == sorted(known)


def test_fused_specs_share_one_exchange(spark, folder):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows, dummies, _ = one_hot(fx.prev(spark, folder), ["status"],
                                   categories={"status": ["F", "O"]})
        fused = aggregate_specs(rows, order_specs()[:3], dummies,
                                occurring=["status_F", "status_O"])[("o_custkey",)]
        assert len(re.findall(r"Exchange hashpartitioning", plan_of(fused))) == 1
        base = fx.main(spark, folder).select("c_custkey")
        frames = {str(i): aggregate(fx.prev(spark, folder).withColumnRenamed(
            "o_custkey", "c_custkey"), "c_custkey", {"cents": ["max"]}, header=f"H{i}")
            for i in range(3)}
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = plan_of(join_features(base, frames, "c_custkey"))
        # the base moves once, each feature table once for its own group-by
        assert len(re.findall(r"Exchange hashpartitioning", joined)) == 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rank_moves_rows_by_bucket_only(spark, folder):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(digest_row_number(fx.prev(spark, folder), "o_orderkey", 1, "rn"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert len(single) == 1
    # what reaches the one task is the aggregate of bucket sizes
    assert "HashAggregate" in lines[single[0] + 1]


def test_scan_reads_only_the_needed_columns(spark, folder):
    out = aggregate(fx.balance(spark, folder).filter("l_tax > 0.05"), "l_orderkey",
                    {"l_quantity": ["sum"]}, header="H")
    plan = plan_of(out)
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_tax:double>", plan)
    assert "GreaterThan(l_tax,0.05)" in plan


def test_rows_of_frequent_keys_are_spread_over_salts(spark, folder):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = fx.balance(spark, folder)
        table = rows.groupBy("l_quantity").agg(F.count("*").alias("n"), F.max("l_tax").alias("m"))
        joined = lookup_join(rows, table, "l_quantity", "n")
        exchanges = re.findall(r"Exchange hashpartitioning\((.*?), 4\)", plan_of(joined))
        salted = [e for e in exchanges if "__salt" in e]
        assert len(salted) == 2 and all("l_quantity" in e for e in salted)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_registered_relational_queries_have_no_cross_join(spark, folder):
    for name in ("win_pct_rank", "encode_factorize", "importance_profile", "class_weights",
                 "split_stratified_kfold", "metric_roc_auc", "build_train_test"):
        plan = plan_of(QUERIES[name](spark, folder))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
