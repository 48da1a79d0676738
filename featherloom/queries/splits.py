"""Validation splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featherloom.operators.splits import (
    kfold, shuffle_split, stratified_kfold, stratified_shuffle_split, time_series_split)
from featherloom.queries import fixtures as fx
from featherloom.queries.registry import query


@query("split_kfold", """
select o_orderkey, cast((row_number() over (order by md5(o_orderkey || '|42'), o_orderkey) - 1) % 5
                        as int) as fold from orders""")
def split_kfold(spark: SparkSession, folder: str) -> DataFrame:
    return kfold(fx.table(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 5)


@query("split_stratified_kfold", fx.FX + """
select o_orderkey, status, cast((row_number() over (
  partition by status order by md5(o_orderkey || '|1001'), o_orderkey) - 1) % 5 as int) as fold
from fx_prev""")
def split_stratified_kfold(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.prev(spark, folder).select("o_orderkey", "status")
    return stratified_kfold(rows, "o_orderkey", "status", 5, 1001)


def _roles(table: str, group: str, test: str, train: str) -> str:
    parts = [f"""
  case when i{s} <= {test} then 'valid' when i{s} <= {test} + {train} then 'train' end
    as split_{s}""" for s in range(2)]
    numbers = [f"row_number() over ({group} order by md5(o_orderkey || '|{42 + s}'), o_orderkey)"
               f" as i{s}" for s in range(2)]
    return f"""
select o_orderkey, status, {', '.join(parts)} from (
  select o_orderkey, status, count(*) over ({group}) as n, {', '.join(numbers)} from {table})"""


@query("split_shuffle", fx.FX + _roles("fx_prev", "", "ceil(n * 0.25)", "floor(n * 0.5)"))
def split_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.prev(spark, folder).select("o_orderkey", "status")
    return shuffle_split(rows, "o_orderkey", 2, 0.25, 0.5)


@query("split_stratified_shuffle",
       fx.FX + _roles("fx_prev", "partition by status", "ceil(n * 0.25)", "(n - ceil(n * 0.25))"))
def split_stratified_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.prev(spark, folder).select("o_orderkey", "status")
    return stratified_shuffle_split(rows, "o_orderkey", "status", 2, 0.25)


@query("split_time_series", """
select o_orderkey, o_orderdate, cast(case when i <= n - 4 * (n // 5) then 0
  else (i - (n - 4 * (n // 5)) - 1) // (n // 5) + 1 end as int) as block
from (select o_orderkey, o_orderdate, count(*) over () as n,
             row_number() over (order by o_orderdate, md5(o_orderkey || '|0'), o_orderkey) as i
      from orders)""")
def split_time_series(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return time_series_split(rows, "o_orderkey", "o_orderdate", 4)
