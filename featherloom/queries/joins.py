"""Joins and unions on entity keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from featherloom.operators.aggregate import aggregate
from featherloom.operators.clean import split_labelled
from featherloom.operators.joins import (
    align_aggregates, concat_columns, join_features, outer_align, reindex, rollup_child,
    union_train_test)
from featherloom.queries import fixtures as fx
from featherloom.queries.registry import as_double, query, rounded


def _orders_per_customer(spark: SparkSession, folder: str) -> DataFrame:
    return aggregate(fx.prev(spark, folder), "o_custkey",
                     {"cents": ["min", "max", "mean", "sum"]}, header="ORD", count=True
                     ).withColumnRenamed("o_custkey", "c_custkey")


def _events_per_customer(spark: SparkSession, folder: str) -> DataFrame:
    return aggregate(fx.events(spark, folder), "user_id", {"value": ["max", "mean"]},
                     header="EV", count=True).withColumnRenamed("user_id", "c_custkey")


_FEATURES = """,
ord as (
  select o_custkey as c_custkey, min(cents) as ORD_cents_MIN, max(cents) as ORD_cents_MAX,
         avg(cents) as ORD_cents_MEAN, sum(cents) as ORD_cents_SUM,
         count(*) as ORD_COUNT_o_custkey from fx_prev group by o_custkey),
ev as (
  select user_id as c_custkey, max(value) as EV_value_MAX, round(avg(value), 6) as EV_value_MEAN,
         count(*) as EV_COUNT_user_id from events group by user_id)
"""


@query("join_features_left", fx.FX + _FEATURES + """
select m.c_custkey, m.segment, round(ORD_cents_MEAN, 6) as ORD_cents_MEAN, ORD_cents_MIN,
       ORD_cents_MAX, ORD_cents_SUM, ORD_COUNT_o_custkey::double as ORD_COUNT_o_custkey,
       EV_value_MAX, EV_value_MEAN, EV_COUNT_user_id::double as EV_COUNT_user_id
from fx_main m left join ord using (c_custkey) left join ev using (c_custkey)""")
def join_left(spark: SparkSession, folder: str) -> DataFrame:
    base = fx.main(spark, folder).select("c_custkey", "segment")
    joined = join_features(base, {"ord": _orders_per_customer(spark, folder),
                                  "ev": _events_per_customer(spark, folder)}, "c_custkey")
    return rounded(as_double(joined, "ORD_COUNT_o_custkey", "EV_COUNT_user_id"))


@query("join_child_rollup", fx.FX + """
select o.o_orderkey, o.o_custkey, o.cents, b.LINE_l_quantity_SUM, b.LINE_COUNT_l_orderkey::double as LINE_COUNT_l_orderkey
from fx_prev o left join (
  select l_orderkey, sum(l_quantity) as LINE_l_quantity_SUM, count(*) as LINE_COUNT_l_orderkey
  from fx_balance group by l_orderkey) b on o.o_orderkey = b.l_orderkey""")
def join_child(spark: SparkSession, folder: str) -> DataFrame:
    lines = aggregate(fx.balance(spark, folder), "l_orderkey", {"l_quantity": ["sum"]},
                      header="LINE", count=True).withColumnRenamed("l_orderkey", "o_orderkey")
    orders = fx.prev(spark, folder).select("o_orderkey", "o_custkey", "cents")
    return as_double(rollup_child(orders, lines, "o_orderkey"), "LINE_COUNT_l_orderkey")


def _by_status(spark: SparkSession, folder: str) -> list[DataFrame]:
    orders = fx.prev(spark, folder)
    return [aggregate(orders, "o_custkey", {"cents": ["max"]}, header="ALL"),
            aggregate(orders.filter("status = 'F'"), "o_custkey", {"cents": ["max"]}, header="F"),
            aggregate(orders.filter("status = 'O'"), "o_custkey", {"cents": ["sum"]}, header="O")]


_STATUS = """,
a as (select o_custkey, max(cents) as ALL_cents_MAX from fx_prev group by 1),
f as (select o_custkey, max(cents) as F_cents_MAX from fx_prev where status = 'F' group by 1),
o as (select o_custkey, sum(cents) as O_cents_SUM from fx_prev
      where status = 'O' group by 1)
"""


@query("join_align_inner", fx.FX + _STATUS + """
select * from a join f using (o_custkey) join o using (o_custkey)""")
def join_align_inner(spark: SparkSession, folder: str) -> DataFrame:
    return align_aggregates(_by_status(spark, folder), "o_custkey")


@query("join_outer_align", fx.FX + _STATUS + """
select * from a full join f using (o_custkey) full join o using (o_custkey)""")
def join_outer_align(spark: SparkSession, folder: str) -> DataFrame:
    return outer_align(_by_status(spark, folder), "o_custkey")


@query("concat_columns_inner", """
select o_orderkey, o_orderstatus, o_custkey, o_totalprice * 2 as doubled from orders""")
def concat_inner(spark: SparkSession, folder: str) -> DataFrame:
    orders = fx.table(spark, folder, "orders")
    return concat_columns([
        orders.select("o_orderkey", "o_orderstatus"), orders.select("o_orderkey", "o_custkey"),
        orders.select("o_orderkey", (F.col("o_totalprice") * 2).alias("doubled"))], "o_orderkey")


@query("join_reindex", fx.FX + """
select c_custkey, F_cents_MAX from fx_main left join (
  select o_custkey as c_custkey, max(cents) as F_cents_MAX from fx_prev where status = 'F'
  group by 1) using (c_custkey)
where target is not null""")
def join_reindex(spark: SparkSession, folder: str) -> DataFrame:
    finished = _by_status(spark, folder)[1].withColumnRenamed("o_custkey", "c_custkey")
    return reindex(finished, fx.main(spark, folder).filter("target is not null"), "c_custkey")


@query("union_by_name", fx.FX + """
select c_custkey, segment, target from fx_main""")
def union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    train, test = split_labelled(fx.main(spark, folder).select("c_custkey", "segment", "target"),
                                 "target")
    return union_train_test(train, test.drop("target"))
