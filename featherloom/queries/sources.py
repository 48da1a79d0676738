"""Sources, sinks and staging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from featherloom.naming import format_run_name, parse_run_name
from featherloom.queries import fixtures as fx
from featherloom.queries.registry import query
from featherloom.report import Report
from featherloom.ml.runs import latest_meta
from featherloom.operators.schema import select_by_stem
from featherloom.operators.topk import best_trial
from featherloom.sources.store import (
    describe_store, load_params, load_tables, read_store, save_params, shared_folder,
    write_meta_features, write_predictions, write_store)


@query("src_load_tables", "select c_custkey, c_nationkey, c_mktsegment, c_acctbal from customer")
def src_load_tables(spark: SparkSession, folder: str) -> DataFrame:
    out = shared_folder(spark)
    (fx.table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
     .write.option("header", True).csv(f"{out}/customer.csv"))
    report = Report()
    loaded = load_tables(spark, {"customer": f"{out}/customer.csv",
                                 "missing": f"{out}/missing.csv"}, report=report)
    assert report.names("load_tables") == ["missing"]
    return loaded["customer"].select(F.col("c_custkey").cast("bigint"),
                                     F.col("c_nationkey").cast("int"),
                                     "c_mktsegment", "c_acctbal")


@query("store_roundtrip", fx.FX + """
select o_orderkey, o_custkey, status, o_orderpriority, o_totalprice, cents from fx_prev""")
def store_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark)
    write_store(spark, path, {"main": fx.main(spark, folder), "prev": fx.prev(spark, folder)})
    assert write_store(spark, path, {}, overwrite=False) is False
    found = read_store(spark, path, ["prev", "absent"])
    assert found["absent"].columns == []
    return found["prev"]


@query("store_describe", fx.FX + """
select 'main' as table_name, (select count(*) from fx_main) as n_rows, 6 as n_columns
union all select 'prev', (select count(*) from fx_prev), 6
union all select 'balance', (select count(*) from fx_balance), 5""")
def store_describe(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark)
    write_store(spark, path, {"main": fx.main(spark, folder), "prev": fx.prev(spark, folder),
                              "balance": fx.balance(spark, folder)}, fast=True)
    return describe_store(spark, path).select("table_name", "n_rows", "n_columns")


@query("write_predictions", """
select c_custkey, cast(floor(abs(c_acctbal)) as int) / 16384 as proba from customer""")
def predictions(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.table(spark, folder, "customer").selectExpr(
        "c_custkey", "cast(floor(abs(c_acctbal)) as int) / 16384 as proba")
    path = write_predictions(rows, f"{shared_folder(spark)}/subm_meta.csv", "c_custkey", "proba")
    return spark.read.schema("c_custkey bigint, proba double").option("header", True).csv(path)


@query("run_name_codec", """
with named as (
  select o_orderkey,
         printf('level[%d]_%s_features[%04d]_score[%.6f]_fold[%d]_%s',
                o_orderkey % 3, o_orderpriority, o_custkey, round(o_totalprice) / 1000000,
                o_orderkey % 7, strftime(o_orderdate, '%Y-%m-%d-%H-%M')) as run_name,
         o_orderpriority, o_custkey, o_totalprice, o_orderdate
  from orders)
select o_orderkey, run_name, cast(o_orderkey % 3 as int) as level, o_orderpriority as model,
       cast(o_custkey as int) as feature_num,
       cast(printf('%.6f', round(o_totalprice) / 1000000) as double) as score,
       cast(o_orderkey % 7 as int) as fold,
       strftime(o_orderdate, '%Y-%m-%d %H:%M') as run_time
from named""")
def run_name_codec(spark: SparkSession, folder: str) -> DataFrame:
    orders = fx.table(spark, folder, "orders")
    named = orders.select("o_orderkey", format_run_name(
        F.col("o_orderkey") % 3, F.col("o_orderpriority"), F.col("o_custkey"),
        F.round("o_totalprice") / 1000000, F.col("o_orderkey") % 7,
        F.col("o_orderdate").cast("timestamp")).alias("run_name"))
    parts = parse_run_name(F.col("run_name"))
    time = F.date_format(parts.pop("timestamp").cast("timestamp"), "yyyy-MM-dd HH:mm")
    return named.select("o_orderkey", "run_name", *[c.alias(n) for n, c in parts.items()],
                        time.alias("run_time"))


@query("store_meta_features", fx.FX + """
select c_custkey, floor(c_acctbal / 8) as "L_0",
       case when target is null then 'test' else 'train' end as part from fx_main""")
def store_meta_features(spark: SparkSession, folder: str) -> DataFrame:
    """Meta features of two runs; the latest pair of the level is read back."""
    path, meta = shared_folder(spark), fx.main(spark, folder).select(
        "c_custkey", F.floor(F.col("c_acctbal") / 8).cast("double").alias("L_0"), "target")
    labelled = meta.where("target is not null").drop("target")
    other = meta.where("target is null").drop("target")
    write_meta_features(spark, path, "sample", "older", other, labelled)
    write_meta_features(spark, path, "sample", "newer", labelled, other)
    train, test = latest_meta(spark, path, "sample")
    return (train.withColumn("part", F.lit("train"))
            .unionByName(test.withColumn("part", F.lit("test"))))


@query("store_params", fx.FX + """
select task, cast(trial as bigint) as trial, score from (
  select *, row_number() over (partition by task order by score desc, trial) as r from fx_trials)
where r = 1""")
def store_params(spark: SparkSession, folder: str) -> DataFrame:
    """Parameters of each task's best and another trial, saved; the better ones are loaded."""
    path, trials = shared_folder(spark), fx.trials(spark, folder)
    best = best_trial(trials).collect()   # one row for each task
    for r in best:
        save_params(spark, path, r["task"], {"trial": -1, "score": 0.0}, r["score"] - 1)
        save_params(spark, path, r["task"], {"trial": r["trial"], "score": r["score"]},
                    r["score"], remove_old=False)
    loaded = {r["task"]: load_params(spark, path, r["task"]) for r in best}
    return spark.createDataFrame([(t, p["trial"], p["score"]) for t, p in loaded.items()],
                                 "task string, trial long, score double")


@query("select_by_stem", """
select l_discount, l_extendedprice, l_linenumber, l_orderkey, l_partkey, l_suppkey from lineitem""")
def columns_by_stem(spark: SparkSession, folder: str) -> DataFrame:
    """Named columns and all whose names hold a stem, once each."""
    rows = fx.table(spark, folder, "lineitem")
    return rows.select(*select_by_stem(rows, ["key", "price", "disc"],
                                       ["l_linenumber", "l_orderkey"]))
