"""Group-by operators: single functions, conditional, fused and two-level."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from featherloom.operators.aggregate import (
    aggregate, aggregate_specs, conditional_aggregate, group_count, two_level)
from featherloom.operators.encode import one_hot
from featherloom.operators.importance import blacklist, importance_profile, importance_totals
from featherloom.operators.joins import union_rows
from featherloom.operators.metrics import class_ratio
from featherloom.operators.topk import mean_by_key
from featherloom.queries import fixtures as fx
from featherloom.queries.registry import query, rounded


@query("agg_grouped", fx.FX + """
select o_custkey, min(cents) as ORD_cents_MIN, max(cents) as ORD_cents_MAX,
       round(avg(cents), 6) as ORD_cents_MEAN, sum(cents) as ORD_cents_SUM,
       count(status) as ORD_status_COUNT, round(median(cents), 6) as ORD_cents_MEDIAN,
       round(stddev_samp(o_orderkey / 1000), 5) as ORD_kilo_STD, count(*) as ORD_COUNT_o_custkey
from fx_prev group by o_custkey""")
def agg_grouped(spark: SparkSession, folder: str) -> DataFrame:
    orders = fx.prev(spark, folder).withColumn("kilo", F.col("o_orderkey") / 1000)
    out = aggregate(orders, "o_custkey", {
        "cents": ["min", "max", "mean", "sum", "median"], "status": ["count"], "kilo": ["std"],
        "absent": ["min"]}, header="ORD", count=True)
    return rounded(out.withColumn("ORD_kilo_STD", F.round("ORD_kilo_STD", 5)))


@query("agg_min_max", fx.FX + """
select l_orderkey, min(l_discount) as B_l_discount_MIN, max(l_discount) as B_l_discount_MAX
from fx_balance group by l_orderkey""")
def agg_min_max(spark: SparkSession, folder: str) -> DataFrame:
    return aggregate(fx.balance(spark, folder), "l_orderkey", {"l_discount": ["min", "max"]},
                     header="B")


@query("agg_mean_sum", fx.FX + """
select l_orderkey, round(avg(l_discount), 6) as B_l_discount_MEAN,
       round(coalesce(sum(l_discount), 0), 6) as B_l_discount_SUM
from fx_balance group by l_orderkey""")
def agg_mean_sum(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(aggregate(fx.balance(spark, folder), "l_orderkey",
                             {"l_discount": ["mean", "sum"]}, header="B"))


@query("agg_var", fx.FX + """
select l_orderkey, round(var_samp(l_quantity), 8) as B_l_quantity_VAR,
       round(var_samp(l_discount), 8) as B_l_discount_VAR
from fx_balance group by l_orderkey""")
def agg_var(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(aggregate(fx.balance(spark, folder), "l_orderkey",
                             {"l_quantity": ["var"], "l_discount": ["var"]}, header="B"), 8)


@query("agg_size", fx.FX + """
select l_orderkey, count(*) as B_l_discount_SIZE from fx_balance group by l_orderkey""")
def agg_size(spark: SparkSession, folder: str) -> DataFrame:
    return aggregate(fx.balance(spark, folder), "l_orderkey", {"l_discount": ["size"]},
                     header="B")


@query("agg_nunique", """
select l_suppkey, count(distinct l_partkey) as B_l_partkey_NUNIQUE,
       count(distinct l_quantity) as B_l_quantity_NUNIQUE from lineitem group by l_suppkey""")
def agg_nunique(spark: SparkSession, folder: str) -> DataFrame:
    return aggregate(fx.table(spark, folder, "lineitem"), "l_suppkey",
                     {"l_partkey": ["nunique"], "l_quantity": ["nunique"]}, header="B")


_SHARES = """
  round(avg((l_returnflag = 'A')::int), 6) as B_l_returnflag_A_MEAN,
  cast(sum((l_returnflag = 'A')::int) as bigint) as B_l_returnflag_A_SUM,
  round(avg((l_returnflag = 'N')::int), 6) as B_l_returnflag_N_MEAN,
  cast(sum((l_returnflag = 'N')::int) as bigint) as B_l_returnflag_N_SUM,
  round(avg((l_returnflag = 'R')::int), 6) as B_l_returnflag_R_MEAN,
  cast(sum((l_returnflag = 'R')::int) as bigint) as B_l_returnflag_R_SUM,
  cast(0 as double) as B_l_returnflag_nan_MEAN, cast(0 as bigint) as B_l_returnflag_nan_SUM
"""


@query("agg_category_share", fx.FX + f"""
select l_orderkey, {_SHARES} from fx_balance group by l_orderkey""")
def agg_category_share(spark: SparkSession, folder: str) -> DataFrame:
    rows, dummies, _ = one_hot(fx.balance(spark, folder), ["l_returnflag"])
    return rounded(aggregate(rows, "l_orderkey", cat_cols=dummies, cat=["mean", "sum"],
                             header="B"))


@query("agg_group_count", fx.FX + """
select o_custkey, status, count(*) as ORD_COUNT_o_custkey_status from fx_prev
where status is not null group by o_custkey, status""")
def agg_group_count(spark: SparkSession, folder: str) -> DataFrame:
    return group_count(fx.prev(spark, folder), ["o_custkey", "status"], "ORD")


@query("agg_conditional", fx.FX + """
select o_custkey, min(cents) as FIN_cents_MIN, max(cents) as FIN_cents_MAX,
       count(*) as FIN_COUNT_o_custkey from fx_prev where status = 'F' group by o_custkey""")
def agg_conditional(spark: SparkSession, folder: str) -> DataFrame:
    return conditional_aggregate(fx.prev(spark, folder), {
        "header": "FIN", "groupby": ["o_custkey"], "num": {"cents": ["min", "max"]},
        "count": True, "subset": {"column_name": "status", "conditions": ["F"]}})


def order_specs(key: str = "o_custkey") -> list[dict]:
    """All, finished and open orders of a customer, plus two specs that cannot run."""
    def one(status: str, header: str) -> dict:
        return {"header": header, "groupby": [key], "count": True, "cat": [],
                "subset": {"column_name": f"status_{status}", "conditions": [1]},
                "num": {"cents": ["min", "max", "mean"]}}
    return [
        {"header": "PREV", "groupby": [key], "cat": ["mean"],
         "num": {"cents": ["min", "max", "mean", "sum"], "absent": ["min"]}},
        one("F", "PREV_F"), one("O", "PREV_O"),
        {"header": "NOCOL", "groupby": [key], "num": {"cents": ["min"]},
         "subset": {"column_name": "PREV_status_F", "conditions": [1]}},
        {"header": "NOROW", "groupby": [key], "num": {"cents": ["min"]},
         "subset": {"column_name": "status_F", "conditions": [2]}}]


_ORDER_SPECS = """
  min(cents) as PREV_cents_MIN, max(cents) as PREV_cents_MAX,
  round(avg(cents), 6) as PREV_cents_MEAN, sum(cents) as PREV_cents_SUM,
  round(avg(coalesce(status = 'F', false)::int), 6) as PREV_status_F_MEAN,
  round(avg(coalesce(status = 'O', false)::int), 6) as PREV_status_O_MEAN,
  round(avg((status is null)::int), 6) as PREV_status_nan_MEAN,
  min(cents) filter (status = 'F') as PREV_F_cents_MIN,
  max(cents) filter (status = 'F') as PREV_F_cents_MAX,
  round(avg(cents) filter (status = 'F'), 6) as PREV_F_cents_MEAN,
  count(*) filter (status = 'F') as PREV_F_COUNT_o_custkey,
  min(cents) filter (status = 'O') as PREV_O_cents_MIN,
  max(cents) filter (status = 'O') as PREV_O_cents_MAX,
  round(avg(cents) filter (status = 'O'), 6) as PREV_O_cents_MEAN,
  count(*) filter (status = 'O') as PREV_O_COUNT_o_custkey
"""


@query("agg_spec_list", fx.FX + f"""
select o_custkey, {_ORDER_SPECS} from fx_prev group by o_custkey
having count(*) filter (status = 'F') > 0 and count(*) filter (status = 'O') > 0""")
def agg_spec_list(spark: SparkSession, folder: str) -> DataFrame:
    rows, dummies, _ = one_hot(fx.prev(spark, folder), ["status"])
    out = aggregate_specs(rows, order_specs(), dummies, occurring=["status_F", "status_O"])
    return rounded(out[("o_custkey",)])


@query("agg_two_level", fx.FX + """, bal as (
  select l_orderkey as o_orderkey, min(l_quantity) as BAL_l_quantity_MIN,
         count(*) as BAL_l_quantity_SIZE, avg((l_returnflag = 'A')::int) as a,
         avg((l_returnflag = 'N')::int) as n, avg((l_returnflag = 'R')::int) as r
  from fx_balance group by l_orderkey)
select o_custkey, max(cents) as PREV_cents_MAX,
       min(BAL_l_quantity_MIN) as PREV_BAL_l_quantity_MIN_MIN,
       cast(coalesce(sum(BAL_l_quantity_SIZE), 0) as bigint) as PREV_BAL_l_quantity_SIZE_SUM,
       round(avg(a), 6) as PREV_BAL_l_returnflag_A_MEAN_MEAN,
       round(avg(n), 6) as PREV_BAL_l_returnflag_N_MEAN_MEAN,
       round(avg(r), 6) as PREV_BAL_l_returnflag_R_MEAN_MEAN
from fx_prev left join bal using (o_orderkey) group by o_custkey""")
def agg_two_level(spark: SparkSession, folder: str) -> DataFrame:
    lines, dummies, _ = one_hot(
        fx.balance(spark, folder).withColumnRenamed("l_orderkey", "o_orderkey"),
        ["l_returnflag"], nan_as_category=False)
    return rounded(two_level(
        lines, fx.prev(spark, folder),
        [{"header": "BAL", "groupby": ["o_orderkey"], "cat": ["mean"],
          "num": {"l_quantity": ["min", "size"]}}],
        [{"header": "PREV", "groupby": ["o_custkey"], "cat": ["mean"],
          "num": {"cents": ["max"], "BAL_l_quantity_MIN": ["min"],
                  "BAL_l_quantity_SIZE": ["sum"],
                  "BAL_l_returnflag_A_MEAN": ["mean", "sum"]}}],
        "o_orderkey", "o_custkey", child_dummies=dummies))


@query("importance_totals", fx.FX + """
select feature, sum(importance) as importance from fx_importances group by feature""")
def totals(spark: SparkSession, folder: str) -> DataFrame:
    return importance_totals(fx.importances(spark, folder))


@query("importance_profile", fx.FX + """, totals as (
  select feature, sum(importance) as x from fx_importances group by feature)
select count(x) as count, round(avg(x), 4) as mean, round(stddev_samp(x), 4) as std,
       min(x) as min, round(quantile_cont(x, 0.1), 4) as p10,
       round(quantile_cont(x, 0.2), 4) as p20, round(quantile_cont(x, 0.25), 4) as p25,
       round(quantile_cont(x, 0.5), 4) as p50, round(quantile_cont(x, 0.75), 4) as p75,
       round(quantile_cont(x, 0.8), 4) as p80, round(quantile_cont(x, 0.9), 4) as p90,
       max(x) as max
from totals""")
def profile(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(importance_profile(importance_totals(fx.importances(spark, folder))), 4)


@query("importance_blacklist", fx.FX + """
select feature, sum(importance) as importance from fx_importances group by feature
having sum(importance) <= 600""")
def black(spark: SparkSession, folder: str) -> DataFrame:
    return blacklist(importance_totals(fx.importances(spark, folder)), 600.0)


@query("agg_class_ratio", fx.FX + """
select target, count(*) / (select count(*) from fx_main where target is not null) as ratio
from fx_main where target is not null group by target""")
def ratio(spark: SparkSession, folder: str) -> DataFrame:
    return class_ratio(fx.main(spark, folder), "target")


@query("agg_mean_over_runs", """
select l_orderkey, avg(l_quantity / 64) as proba from lineitem group by l_orderkey""")
def mean_over_runs(spark: SparkSession, folder: str) -> DataFrame:
    lines = fx.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") / 64).alias("proba"))
    runs = [lines.filter(c).drop("l_linenumber")
            for c in ("l_linenumber <= 2", "l_linenumber > 2")]
    return mean_by_key(union_rows(runs), "l_orderkey")
