"""Spec-driven builds: one entity table, the train/test matrix, cached stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from featherloom.plans.build import (
    LEVELS, STAGES, build_main, build_matrix, staged_build)
from featherloom.plans.loan_like import KEY, SPECS, TARGET
from featherloom.queries import fixtures as fx
from featherloom.queries.registry import as_double, query, rounded
from featherloom.report import Report
from featherloom.sources.store import read_store, shared_folder, write_store


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    main = fx.main(spark, folder).withColumn(
        "grade", F.concat(F.lit("G"), (F.col("c_nationkey") % 3).cast("string")))
    return {
        "main": main,
        "prev": fx.prev(spark, folder).withColumnRenamed("o_custkey", KEY)
        .drop("o_totalprice", "o_orderpriority"),
        "balance": fx.balance(spark, folder).withColumnRenamed("l_orderkey", "o_orderkey"),
        "events": fx.events(spark, folder).withColumnRenamed("user_id", KEY).drop("ts"),
    }


_MAIN = """, codes as (
  select 'G' || (c_nationkey % 3) as grade,
         cast(row_number() over (order by min(c_custkey)) - 1 as int) as code
  from fx_main where segment is null or segment <> 'MACHINERY' group by 1),
entity as (
  select c_custkey, c_nationkey, c_acctbal, target, nullif(days_x, 365243) as days_x, segment,
         'G' || (c_nationkey % 3) as grade
  from fx_main where segment is null or segment <> 'MACHINERY'),
built as (
  select c_custkey, c_nationkey, c_acctbal, target, code as grade, days_x,
    coalesce(segment = 'AUTOMOBILE', false)::int as "segment_AUTOMOBILE",
    coalesce(segment = 'BUILDING', false)::int as "segment_BUILDING",
    coalesce(segment = 'HOUSEHOLD', false)::int as "segment_HOUSEHOLD",
    (segment is null)::int as segment_nan,
    case when c_nationkey = 0 then case when days_x > 0 then 'infinity'::double end
         else days_x / c_nationkey end as "DAYS_TO_NATION",
    cast(case when days_x > c_nationkey then days_x - c_nationkey else 0 end as double)
      as "DAYS_DIFF",
    cast(coalesce(days_x, 0) + c_nationkey as double) as "ROW_SUM",
    (coalesce(days_x, 0) + c_nationkey) / (1 + (days_x is not null)::int) as "ROW_MEAN"
  from entity join codes using (grade))
"""


def _six(df: DataFrame) -> DataFrame:
    """Rounds to 6 digits; the infinite ratios stay infinite."""
    ratio = F.col("DAYS_TO_NATION")
    kept = df.withColumn("__inf", F.abs(ratio) == float("inf"))
    out = rounded(kept.withColumn("DAYS_TO_NATION", F.when(F.col("__inf"), 0.0).otherwise(ratio)))
    return out.withColumn("DAYS_TO_NATION", F.when(F.col("__inf"), float("inf"))
                          .otherwise(F.col("DAYS_TO_NATION"))).drop("__inf")


_ROUND_MAIN = """
  case when isinf("DAYS_TO_NATION") then "DAYS_TO_NATION" else round("DAYS_TO_NATION", 6) end
    as "DAYS_TO_NATION", round("ROW_MEAN", 6) as "ROW_MEAN"
"""


@query("build_entity_features", fx.FX + _MAIN + f"""
select * exclude ("DAYS_TO_NATION", "ROW_MEAN"), {_ROUND_MAIN} from built""")
def build_entity_features(spark: SparkSession, folder: str) -> DataFrame:
    report = Report()
    out = build_main(raw_tables(spark, folder)["main"], SPECS["main"], KEY, TARGET, report)
    assert report.names("interaction") == ["ABSENT"]
    return _six(out)


_HISTORIES = """,
bal as (
  select l_orderkey as o_orderkey, min(l_quantity) as q_min, count(*) as q_size,
         avg((l_returnflag = 'A')::int) as a, avg((l_returnflag = 'N')::int) as n,
         avg((l_returnflag = 'R')::int) as r, 0.0::double as x
  from fx_balance group by l_orderkey),
prev_agg as (
  select o_custkey as c_custkey, min(cents) as "PREV_cents_MIN", max(cents) as "PREV_cents_MAX",
    round(avg(cents), 6) as "PREV_cents_MEAN", sum(cents) as "PREV_cents_SUM",
    max(cents - o_orderkey) as "PREV_CENTS_PER_KEY_MAX",
    min(q_min) as "PREV_BAL_l_quantity_MIN_MIN",
    round(avg(q_size), 6) as "PREV_BAL_l_quantity_SIZE_MEAN",
    cast(coalesce(sum(q_size), 0) as bigint) as "PREV_BAL_l_quantity_SIZE_SUM",
    round(avg(a), 6) as "PREV_BAL_l_returnflag_A_MEAN_MEAN",
    round(avg(n), 6) as "PREV_BAL_l_returnflag_N_MEAN_MEAN",
    round(avg(r), 6) as "PREV_BAL_l_returnflag_R_MEAN_MEAN",
    round(avg(x), 6) as "PREV_BAL_l_returnflag_nan_MEAN_MEAN",
    round(avg(coalesce(status = 'F', false)::int), 6) as "PREV_status_F_MEAN",
    round(avg(coalesce(status = 'O', false)::int), 6) as "PREV_status_O_MEAN",
    round(avg((status is null)::int), 6) as "PREV_status_nan_MEAN",
    min(cents) filter (status = 'F') as "PREV_F_cents_MIN",
    max(cents) filter (status = 'F') as "PREV_F_cents_MAX",
    round(avg(cents) filter (status = 'F'), 6) as "PREV_F_cents_MEAN",
    count(*) filter (status = 'F') as "PREV_F_COUNT_c_custkey",
    min(cents) filter (status = 'O') as "PREV_O_cents_MIN",
    max(cents) filter (status = 'O') as "PREV_O_cents_MAX",
    round(avg(cents) filter (status = 'O'), 6) as "PREV_O_cents_MEAN",
    count(*) filter (status = 'O') as "PREV_O_COUNT_c_custkey"
  from fx_prev left join bal using (o_orderkey) group by o_custkey
  having count(*) filter (status = 'F') > 0 and count(*) filter (status = 'O') > 0),
ev_agg as (
  select user_id as c_custkey, min(value) as "EV_value_MIN", max(value) as "EV_value_MAX",
    round(avg(value), 6) as "EV_value_MEAN", round(var_samp(value), 6) as "EV_value_VAR",
    count(*) as "EV_event_id_SIZE",
    TYPES
    cast(0 as bigint) as "EV_event_type_nan_SUM", count(*) as "EV_COUNT_c_custkey"
  from events group by user_id)
""".replace("TYPES", "\n    ".join(
    f"""cast(sum((event_type = '{t}')::int) as bigint) as "EV_event_type_{t}_SUM","""
    for t in ("click", "error", "purchase", "signup", "view")))


_NULLABLE = (["PREV_BAL_l_quantity_SIZE_SUM", "PREV_F_COUNT_c_custkey", "PREV_O_COUNT_c_custkey",
              "EV_event_id_SIZE", "EV_event_type_nan_SUM", "EV_COUNT_c_custkey"]
             + [f"EV_event_type_{t}_SUM"
                for t in ("click", "error", "purchase", "signup", "view")])
_COUNTS = ", ".join(f'"{c}"::double as "{c}"' for c in _NULLABLE)


@query("build_train_test", fx.FX + _MAIN + _HISTORIES + f"""
select * exclude ("DAYS_TO_NATION", "ROW_MEAN") replace ({_COUNTS}), {_ROUND_MAIN}
from built left join prev_agg using (c_custkey) left join ev_agg using (c_custkey)""")
def train_test(spark: SparkSession, folder: str) -> DataFrame:
    matrix = build_matrix(raw_tables(spark, folder), SPECS, KEY, TARGET)
    return _six(as_double(matrix, *_NULLABLE))


@query("staged_build", fx.FX + _MAIN + _HISTORIES + """
select level, c_custkey, target, "segment_BUILDING", days_x,
       "PREV_F_COUNT_c_custkey"::double as "PREV_F_COUNT_c_custkey",
       "EV_COUNT_c_custkey"::double as "EV_COUNT_c_custkey"
from built left join prev_agg using (c_custkey) left join ev_agg using (c_custkey)
cross join (values ('from_csv'), ('from_raw_cache'), ('from_processed'), ('from_train_test'))
  levels(level)""")
def staged(spark: SparkSession, folder: str) -> DataFrame:
    first = shared_folder(spark)
    out = None
    for level, number in LEVELS.items():
        # each level enters at its own copy of the cache, and rewrites only later ones
        path = first if number == 0 else shared_folder(spark)
        if number:
            cache = f"cache_sample_{STAGES[number]}"
            write_store(spark, f"{path}/{cache}", read_store(spark, f"{first}/{cache}"))
        halves = staged_build(spark, level, "sample", path, SPECS, KEY, TARGET,
                              lambda: raw_tables(spark, folder))
        rows = halves["train"].union(halves["test"]).select(
            F.lit(level).alias("level"), "c_custkey", "target", "segment_BUILDING",
            F.col("days_x").cast("double").alias("days_x"),
            F.col("PREV_F_COUNT_c_custkey").cast("double").alias("PREV_F_COUNT_c_custkey"),
            F.col("EV_COUNT_c_custkey").cast("double").alias("EV_COUNT_c_custkey"))
        out = rows if out is None else out.union(rows)
    return out
