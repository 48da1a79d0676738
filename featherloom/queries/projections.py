"""Filters, replacement, column lists, two-column arithmetic and row statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from featherloom.operators.clean import (
    drop_rows, nan_to_num, narrow_types, replace_values, split_labelled, subset)
from featherloom.operators.interact import interaction, pair_geometric, row_stats
from featherloom.operators.schema import align_columns, cull_features
from featherloom.operators.topk import head
from featherloom.queries import fixtures as fx
from featherloom.queries.registry import query, rounded


@query("filter_drop_rows", fx.FX + """
select * from fx_prev
where not coalesce(status in ('O'), false) and not coalesce(o_orderpriority in ('1-URGENT'), false)
""")
def filter_drop_rows(spark: SparkSession, folder: str) -> DataFrame:
    return drop_rows(fx.prev(spark, folder), {"status": ["O"], "o_orderpriority": ["1-URGENT"],
                                              "absent": ["x"]})


@query("project_replace_values", fx.FX + """
select c_custkey, c_nationkey, case when segment = 'BUILDING' then 'HOME' else segment end as segment,
       nullif(days_x, 365243) as days_x, c_acctbal, target from fx_main""")
def project_replace_values(spark: SparkSession, folder: str) -> DataFrame:
    return replace_values(fx.main(spark, folder), {
        "days_x": {365243: None}, "segment": {"BUILDING": "HOME"}, "absent": {1: None}})


@query("filter_subset", """
select event_id, user_id, event_type, value, ts from events
where event_type in ('click', 'error')""")
def filter_subset(spark: SparkSession, folder: str) -> DataFrame:
    return subset(fx.events(spark, folder), "event_type", ["click", "error"])


@query("split_labelled", fx.FX + """
select c_custkey, target, case when target is null then 'test' else 'train' end as part
from fx_main""")
def split(spark: SparkSession, folder: str) -> DataFrame:
    train, test = split_labelled(fx.main(spark, folder).select("c_custkey", "target"), "target")
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@query("project_narrow_types", fx.FX + """
select o_orderkey, cast(o_custkey as int) as o_custkey, cast(cents as int) as cents_int,
       cast(o_totalprice as float) as o_totalprice,
       o_orderkey * 1000000 + 2147483653 as wide from fx_prev""")
def project_narrow_types(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.prev(spark, folder).select(
        "o_orderkey", "o_custkey", F.col("cents").cast("bigint").alias("cents_int"),
        "o_totalprice", (F.col("o_orderkey") * 1000000 + 2147483653).alias("wide"))
    return narrow_types(rows, keep=["o_orderkey"])


@query("cull_features", fx.FX + "select c_custkey, segment, days_x, target from fx_main")
def cull(spark: SparkSession, folder: str) -> DataFrame:
    return cull_features(fx.main(spark, folder), ["c_nationkey", "c_acctbal", "absent"])


@query("align_train_test", fx.FX + """
select c_custkey, c_nationkey, days_x, segment, target from fx_main""")
def align(spark: SparkSession, folder: str) -> DataFrame:
    train, test = split_labelled(fx.main(spark, folder), "target")
    train, test = align_columns(train.withColumn("train_only", F.lit(1)),
                                test.drop("c_acctbal"), "target", ["c_custkey"])
    return train.union(test)


@query("project_nan_to_num", fx.FX + """
select l_orderkey, coalesce(l_discount, 0) as l_discount,
       case when l_tax = 0 then 1.7976931348623157e308 else l_quantity / l_tax end as ratio,
       case when l_tax = 0 then -1.7976931348623157e308 else -l_quantity / l_tax end as negative
from fx_balance""")
def project_nan_to_num(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = interaction(
        fx.balance(spark, folder).withColumn("minus", -F.col("l_quantity")),
        [{"name": "ratio", "mode": "divide", "a": "l_quantity", "b": "l_tax"},
         {"name": "negative", "mode": "divide", "a": "minus", "b": "l_tax"}])
    return nan_to_num(rows.select("l_orderkey", "l_discount", "ratio", "negative"))


@query("limit_head", "select o_orderkey, o_custkey, o_totalprice from orders "
                     "order by o_orderkey limit 500")
def limit_head(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return head(rows, 500, "o_orderkey")


@query("interact_arith", """
select l_orderkey, l_quantity + l_linenumber as added, l_quantity - l_linenumber as subtracted,
       l_quantity * l_linenumber as multiplied from lineitem""")
def interact_arith(spark: SparkSession, folder: str) -> DataFrame:
    pair = {"a": "l_quantity", "b": "l_linenumber"}
    rows, made = interaction(fx.table(spark, folder, "lineitem"), [
        {"name": "added", "mode": "add", **pair},
        {"name": "subtracted", "mode": "subtract", **pair},
        {"name": "multiplied", "mode": "multiply", **pair},
        {"name": "unknown", "mode": "modulo", **pair},
        {"name": "missing", "mode": "add", "a": "l_quantity", "b": "absent"}])
    return rows.select("l_orderkey", *made)


@query("interact_subtract_positive", fx.FX + """
select l_orderkey, case when l_discount - l_tax > 0 then round(l_discount - l_tax, 6) else 0 end
  as excess from fx_balance""")
def interact_subtract_positive(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = interaction(fx.balance(spark, folder), [
        {"name": "excess", "mode": "subtract_positive", "a": "l_discount", "b": "l_tax"}])
    return rounded(rows.select("l_orderkey", "excess"))


@query("interact_divide", fx.FX + """
select l_orderkey,
  case when l_tax = 0 then case when l_quantity > 0 then 'infinity'::double
                                when l_quantity < 0 then '-infinity'::double end
       else round(l_quantity / l_tax, 6) end as ratio,
  case when l_tax = 0 then case when l_discount > 0 then 'infinity'::double end
       else round(l_discount / l_tax, 6) end as cut_ratio,
  round(l_quantity / (l_tax + 1), 6) as ratio_nonzero
from fx_balance""")
def interact_divide(spark: SparkSession, folder: str) -> DataFrame:
    rows, made = interaction(fx.balance(spark, folder), [
        {"name": "ratio", "mode": "divide", "a": "l_quantity", "b": "l_tax"},
        {"name": "cut_ratio", "mode": "divide", "a": "l_discount", "b": "l_tax"},
        {"name": "ratio_nonzero", "mode": "divide_nonzero", "a": "l_quantity", "b": "l_tax"}])
    return rows.select("l_orderkey", *[
        F.when(F.abs(F.col(c)) == float("inf"), F.col(c)).otherwise(F.round(c, 6)).alias(c)
        for c in made])


@query("interact_sum_squared", fx.FX + """
select l_orderkey, round(coalesce(l_discount * l_discount, 0) + l_quantity * l_quantity, 6)
  as squares from fx_balance""")
def interact_sum_squared(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = interaction(fx.balance(spark, folder), [
        {"name": "squares", "mode": "sum_squared", "a": "l_discount", "b": "l_quantity"}])
    return rounded(rows.select("l_orderkey", "squares"))


_ROW = """, wide as (
  select l_orderkey, l_quantity as a, nullif(round(l_discount * 100), 0) as b,
         nullif(round(l_tax * 100), 0) as c, cast(l_linenumber as double) as d
  from lineitem),
parts as (
  select *, 2 + (b is not null)::int + (c is not null)::int as n,
         a + coalesce(b, 0) + coalesce(c, 0) + d as s
  from wide),
moments as (
  select *, s / n as m,
    coalesce((a - s / n) ** 2, 0) + coalesce((b - s / n) ** 2, 0)
      + coalesce((c - s / n) ** 2, 0) + coalesce((d - s / n) ** 2, 0) as m2,
    coalesce((a - s / n) ** 4, 0) + coalesce((b - s / n) ** 4, 0)
      + coalesce((c - s / n) ** 4, 0) + coalesce((d - s / n) ** 4, 0) as m4
  from parts)
"""


def _wide(spark: SparkSession, folder: str) -> DataFrame:
    """Four columns with missing values in two of them."""
    return fx.table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_quantity as a", "nullif(round(l_discount * 100), 0) as b",
        "nullif(round(l_tax * 100), 0) as c", "cast(l_linenumber as double) as d")


def _stats(spark: SparkSession, folder: str, *methods: str) -> DataFrame:
    rows = row_stats(_wide(spark, folder), {
        "header": "ROW", "transform": list(methods), "columns": ["a", "b", "c", "d", "absent"]})
    return rounded(rows.select("l_orderkey", *[f"ROW_{m.upper()}" for m in methods]), 5)


@query("row_kurtosis", fx.FX + _ROW + """
select l_orderkey, round(case when n < 4 then null when m2 = 0 then 0
  else n * (n + 1) * (n - 1) * m4 / ((n - 2) * (n - 3) * m2 * m2)
       - 3.0 * (n - 1) ** 2 / ((n - 2) * (n - 3)) end, 5) as ROW_KURTOSIS from moments""")
def row_kurtosis(spark: SparkSession, folder: str) -> DataFrame:
    return _stats(spark, folder, "kurtosis")


@query("row_mean_sum", fx.FX + _ROW + """
select l_orderkey, round(m, 5) as ROW_MEAN, round(s, 5) as ROW_SUM from moments""")
def row_mean_sum(spark: SparkSession, folder: str) -> DataFrame:
    return _stats(spark, folder, "mean", "sum")


@query("row_sum_squared", fx.FX + _ROW + """
select l_orderkey, round(a * a + coalesce(b * b, 0) + coalesce(c * c, 0) + d * d, 5)
  as ROW_SUM_SQUARED from moments""")
def row_sum_squared(spark: SparkSession, folder: str) -> DataFrame:
    return _stats(spark, folder, "sum_squared")


@query("row_product", fx.FX + _ROW + """
select l_orderkey, round(a * coalesce(b, (select avg(b) from parts))
                           * coalesce(c, (select avg(c) from parts)) * d, 5) as ROW_PRODUCT
from parts""")
def row_product(spark: SparkSession, folder: str) -> DataFrame:
    return _stats(spark, folder, "product")


@query("row_std", fx.FX + _ROW + """, stds as (
  select l_orderkey, case when n > 1 then sqrt(m2 / (n - 1)) end as v from moments)
select l_orderkey, round(coalesce(v, (select avg(v) from stds)), 5) as ROW_STD from stds""")
def row_std(spark: SparkSession, folder: str) -> DataFrame:
    return _stats(spark, folder, "std")


@query("pair_geometric", fx.FX + """
select l_orderkey, coalesce(l_discount, 0) as l_discount, l_quantity, l_tax,
  round(sqrt(l_quantity * coalesce(l_discount, 1)), 6) as l_quantity_X_l_discount,
  round(sqrt(l_quantity * l_tax), 6) as l_quantity_X_l_tax,
  round(sqrt(coalesce(l_discount, 1) * l_tax), 6) as l_discount_X_l_tax
from fx_balance""")
def pair(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.balance(spark, folder).drop("l_returnflag")
    return rounded(pair_geometric(rows, ["l_quantity", "l_discount", "l_tax"]))
