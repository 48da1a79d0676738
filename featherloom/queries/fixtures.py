"""Loan-like views of the driver tables, in Spark and as SQL.

They add the missing values, sentinels and unlabelled rows that the driver
tables lack. ``cents`` is the order price in whole cents, whose sums are exact in a double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def main(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "c_custkey", "c_nationkey", "nullif(c_mktsegment, 'FURNITURE') as segment",
        "case when c_acctbal < 0 then 365243 else cast(floor(c_acctbal) as double) end as days_x",
        "c_acctbal",
        "case when c_custkey % 5 = 0 then null else cast(cast(c_acctbal < 2500 as int) as double) end as target")


def prev(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey", "o_custkey", "nullif(o_orderstatus, 'P') as status", "o_orderpriority",
        "o_totalprice", "round(o_totalprice * 100) as cents")


def balance(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_returnflag", "l_quantity", "l_tax",
        "nullif(l_discount, 0) as l_discount")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", "value", "ts")


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    marks = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("target"))
    return docs.join(marks, "doc_id", "left")


def trials(spark: SparkSession, folder: str) -> DataFrame:
    """Scored trials: one per event, the event type is the task."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("task"), F.col("event_id").alias("trial"),
        F.col("value").alias("score"))


def importances(spark: SparkSession, folder: str) -> DataFrame:
    """Importance rows: the parts are features, the lines of an order are folds."""
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("part_"), F.col("l_partkey").cast("string")).alias("feature"),
        F.col("l_quantity").alias("importance"), F.col("l_linenumber").alias("fold"))


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Key, binary label, class and the embedding as an array of doubles."""
    return table(spark, folder, "embeddings").select(
        "vec_id", F.col("label").alias("digit"), (F.col("label") > 4).cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("x"))


FX = """
with fx_main as (
  select c_custkey, c_nationkey, nullif(c_mktsegment, 'FURNITURE') as segment,
         case when c_acctbal < 0 then 365243 else cast(floor(c_acctbal) as double) end as days_x,
         c_acctbal,
         case when c_custkey % 5 = 0 then null else cast(cast(c_acctbal < 2500 as int) as double) end as target
  from customer),
fx_prev as (
  select o_orderkey, o_custkey, nullif(o_orderstatus, 'P') as status, o_orderpriority,
         o_totalprice, round(o_totalprice * 100) as cents from orders),
fx_balance as (
  select l_orderkey, l_returnflag, l_quantity, l_tax, nullif(l_discount, 0) as l_discount
  from lineitem),
fx_trials as (
  select event_type as task, event_id as trial, value as score from events),
fx_importances as (
  select 'part_' || l_partkey as feature, l_quantity as importance, l_linenumber as fold
  from lineitem),
fx_labelled as (
  select d.doc_id, d.lang, d.source, d.n_chars, l.quality as target
  from documents d left join labels l using (doc_id))
"""
