"""Percentile ranks, running best, best trial and ranking metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from featherloom.ml.search import best_so_far
from featherloom.operators.metrics import log_loss, roc_auc
from featherloom.operators.rank import pct_rank
from featherloom.operators.topk import best_trial
from featherloom.queries import fixtures as fx
from featherloom.queries.registry import query, rounded


@query("win_pct_rank", fx.FX + """
select l_orderkey, l_quantity, l_discount,
  case when l_discount is not null then
    (rank() over (order by l_discount nulls last)
     + (count(*) over (partition by l_discount) - 1) / 2) / (select count(l_discount) from fx_balance)
  end as l_discount_pct,
  (rank() over (order by l_quantity) + (count(*) over (partition by l_quantity) - 1) / 2)
    / count(*) over () as l_quantity_pct
from fx_balance""")
def win_pct_rank(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.balance(spark, folder).select("l_orderkey", "l_quantity", "l_discount")
    return pct_rank(rows, ["l_discount", "l_quantity"], "_pct")


@query("win_pct_rank_decimal", """
select l_orderkey, l_linenumber, price, (rank() over (order by price)
  + (count(*) over (partition by price) - 1) / 2) / count(*) over () as price_pct
from (select l_orderkey, l_linenumber, cast(floor(l_extendedprice / 8) as double) as price
      from lineitem)""")
def win_pct_rank_decimal(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.floor(F.col("l_extendedprice") / 8).cast("decimal(20,4)").alias("price"))
    return pct_rank(rows, ["price"], "_pct").withColumn("price", F.col("price").cast("double"))


@query("win_best_so_far", fx.FX + """
select task, trial, score, max(score) over (
  partition by task order by trial rows unbounded preceding) as best_score from fx_trials""")
def win_best_so_far(spark: SparkSession, folder: str) -> DataFrame:
    return best_so_far(fx.trials(spark, folder))


@query("topk_best_trial", fx.FX + """
select task, trial, score from (
  select *, row_number() over (partition by task order by score desc, trial) as r from fx_trials)
where r = 1""")
def topk_best_trial(spark: SparkSession, folder: str) -> DataFrame:
    return best_trial(fx.trials(spark, folder))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return fx.table(spark, folder, "lineitem").select(
        "l_linestatus", "l_extendedprice", ((F.col("l_quantity") - 0.5) / 50).alias("proba"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"))


@query("metric_roc_auc", """
with scored as (
  select l_linestatus, (l_returnflag = 'R')::int as y,
         rank() over (partition by l_linestatus order by l_extendedprice)
         + (count(*) over (partition by l_linestatus, l_extendedprice) - 1) / 2 as r
  from lineitem)
select l_linestatus, round((sum(r) filter (y = 1) - sum(y) * (sum(y) + 1) / 2)
       / (sum(y) * (count(*) - sum(y))), 9) as auc
from scored group by l_linestatus""")
def metric_roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(roc_auc(_scored(spark, folder), "l_extendedprice", "y", ["l_linestatus"]), 9)


@query("metric_log_loss", """
select l_linestatus, round(avg(-ln(case when l_returnflag = 'R' then (l_quantity - 0.5) / 50
                                        else 1 - (l_quantity - 0.5) / 50 end)), 6) as log_loss
from lineitem group by l_linestatus""")
def metric_log_loss(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(log_loss(_scored(spark, folder), "proba", "y", ["l_linestatus"]))
