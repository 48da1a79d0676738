"""Dummy columns, integer codes, class weights and feature reducers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from featherloom.ml.reduce import decompose, gram
from featherloom.ml.runs import cull_by_runs
from featherloom.operators.encode import category_shares, class_weights, factorize, one_hot
from featherloom.queries import fixtures as fx
from featherloom.queries.registry import query, rounded
from featherloom.sources.store import shared_folder, write_store

_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("encode_one_hot", fx.FX + "select o_orderkey, cents, " + ", ".join(
    f"""(o_orderpriority = '{p}')::int as "o_orderpriority_{p}\"""" for p in _PRIORITIES) + """,
  0 as o_orderpriority_nan, coalesce(status = 'F', false)::int as "status_F",
  coalesce(status = 'O', false)::int as "status_O", (status is null)::int as status_nan
from fx_prev""")
def encode_one_hot(spark: SparkSession, folder: str) -> DataFrame:
    rows, _, _ = one_hot(fx.prev(spark, folder).drop("o_custkey", "o_totalprice"))
    return rows


@query("encode_factorize", fx.FX + """, first as (
  select status, row_number() over (order by min(o_orderkey)) - 1 as code from fx_prev
  where status is not null group by status)
select o_orderkey, cast(coalesce(code, -1) as int) as status, cast(p.c as int) as o_orderpriority
from fx_prev left join first using (status) join (
  select o_orderpriority, row_number() over (order by min(o_orderkey)) - 1 as c from fx_prev
  group by 1) p using (o_orderpriority)""")
def encode_factorize(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.prev(spark, folder).select("o_orderkey", "status", "o_orderpriority")
    return factorize(rows, ["status", "o_orderpriority", "absent"], "o_orderkey")


@query("encode_factorize_string_key", fx.FX + """, first as (
  select status, row_number() over (order by min(cast(o_orderkey as varchar))) - 1 as code
  from fx_prev where status is not null group by status)
select cast(o_orderkey as varchar) as o_orderkey, cast(coalesce(code, -1) as int) as status
from fx_prev left join first using (status)""")
def encode_factorize_string_key(spark: SparkSession, folder: str) -> DataFrame:
    rows = fx.prev(spark, folder).select(F.col("o_orderkey").cast("string"), "status")
    return factorize(rows, ["status"], "o_orderkey")


@query("class_weights", fx.FX + """, sizes as (
  select target, count(*) as n from fx_main where target is not null group by target)
select c_custkey, target, (select sum(n) from sizes) / ((select count(*) from sizes) * n)
  as class_weight
from fx_main left join sizes using (target)""")
def weights(spark: SparkSession, folder: str) -> DataFrame:
    return class_weights(fx.main(spark, folder).select("c_custkey", "target"), "target")


def _reduced(spark: SparkSession, folder: str, name: str, kind: str,
             params: Mapping) -> DataFrame:
    """Key and components of the embedding dimensions."""
    rows = fx.vectors(spark, folder)
    width = 64
    rows = rows.select("vec_id", *[F.col("x")[i].alias(f"dim_{i:02d}") for i in range(width)])
    out = decompose(rows, {"stems": ["dim_"], "methods": {name: {"object": kind,
                                                               "params": params}}})
    return out.select("vec_id", *[c for c in out.columns if c.startswith(f"{name}_")])


@query("reduce_lda_mixture", "select vec_id, 1.0::double as whole from embeddings")
def reduce_lda_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector has one topic mixture, and its parts sum to 1."""
    out = reduce_lda(spark, folder)
    parts = [F.col(c) for c in out.columns if c != "vec_id"]
    return out.select("vec_id", F.round(sum(parts, F.lit(0.0)), 6).alias("whole"))


@query("gram_matrix", """
with x as (select vec_id, unnest(embedding)::double as v,
                  generate_subscripts(embedding, 1) - 1 as i from embeddings)
select a.i::int as i, b.i::int as j, round(sum(a.v * b.v), 6) as value
from x a join x b on a.vec_id = b.vec_id and a.i <= b.i group by 1, 2""")
def gram_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Sums of products of all pairs of embedding dimensions."""
    return rounded(gram(fx.vectors(spark, folder), "x", 64))


@query("reduce_pca_covariances", """
select i::int as i, j::int as j, true as centred, true as uncorrelated, true as ordered
from (select unnest(range(4)) as i), (select unnest(range(4)) as j)
where i < j and (select count(*) from embeddings) > 0""")
def reduce_pca_covariances(spark: SparkSession, folder: str) -> DataFrame:
    """Components have mean 0, no covariance, and falling variances."""
    out, n = reduce_pca(spark, folder), 4
    names = [c for c in out.columns if c != "vec_id"]
    sums = out.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
                   *[F.covar_pop(names[i], names[j]).alias(f"c{i}{j}")
                     for i in range(n) for j in range(i, n)])
    pairs = F.array(*[F.struct(
        F.lit(i).alias("i"), F.lit(j).alias("j"),
        ((F.abs(f"m{i}") < 1e-9) & (F.abs(f"m{j}") < 1e-9)).alias("centred"),
        (F.abs(f"c{i}{j}") < 1e-9).alias("uncorrelated"),
        (F.col(f"c{i}{i}") >= F.col(f"c{j}{j}")).alias("ordered"))
        for i in range(n) for j in range(i + 1, n)])
    return sums.select(F.explode(pairs).alias("pair")).select("pair.*")


@query("reduce_svd_orthogonal", """
select i::int as i, j::int as j, true as orthogonal, true as ordered
from (select unnest(range(4)) as i), (select unnest(range(4)) as j)
where i < j and (select count(*) from embeddings) > 0""")
def reduce_svd_orthogonal(spark: SparkSession, folder: str) -> DataFrame:
    """Sums of products of two components vanish, and their squared lengths fall."""
    out, n = reduce_svd(spark, folder), 4
    x = [F.col(c) for c in out.columns if c != "vec_id"]
    sums = out.agg(*[F.sum(x[i] * x[j]).alias(f"c{i}{j}") for i in range(n) for j in range(i, n)])
    pairs = F.array(*[F.struct(
        F.lit(i).alias("i"), F.lit(j).alias("j"),
        (F.abs(f"c{i}{j}") < 1e-9 * F.col("c00")).alias("orthogonal"),
        (F.col(f"c{i}{i}") >= F.col(f"c{j}{j}")).alias("ordered"))
        for i in range(n) for j in range(i + 1, n)])
    return sums.select(F.explode(pairs).alias("pair")).select("pair.*")


@query("reduce_nmf_parts", "select vec_id, true as valid from embeddings")
def reduce_nmf_parts(spark: SparkSession, folder: str) -> DataFrame:
    """No factor is negative."""
    out = reduce_nmf(spark, folder)
    return out.select("vec_id", (F.array_min(F.array(
        *[F.col(c) for c in out.columns if c != "vec_id"])) >= 0).alias("valid"))


@query("reduce_projections_linear", """
select label as digit, kind, true as linear, count(*) as n
from embeddings, (values ('Gaussian'), ('Sparse')) kinds(kind) group by label, kind""")
def reduce_projections_linear(spark: SparkSession, folder: str) -> DataFrame:
    """The projection of each digit's mean vector is the mean of its vectors' projections."""
    rows = fx.vectors(spark, folder)
    names = [f"dim_{i:02d}" for i in range(64)]
    single = rows.select("vec_id", "digit", *[F.col("x")[i].alias(n)
                                              for i, n in enumerate(names)])
    means = single.groupBy("digit").agg(*[F.avg(n).alias(n) for n in names]).withColumn(
        "vec_id", F.lit(None).cast("long"))
    both, found = single.unionByName(means), []
    for kind in ("Gaussian", "Sparse"):
        out = decompose(both, {"stems": ["dim_"], "methods": {"RP": {
            "object": f"{kind}RandomProjection", "params": {"n_components": 4}}}})
        parts = [c for c in out.columns if c.startswith("RP_")]
        alone = F.col("vec_id").isNull()
        apart = [F.abs(F.max(F.when(alone, F.col(c))) - F.avg(F.when(~alone, F.col(c)))) < 1e-9
                 for c in parts]
        found.append(out.groupBy("digit").agg(
            F.array_min(F.array(*apart)).alias("linear"), F.count("vec_id").alias("n"))
            .withColumn("kind", F.lit(kind)))
    return found[0].unionByName(found[1])


@query("agg_wide_category_share", """
select l_suppkey, cast(l_orderkey as varchar) as value,
       round(count(*) / sum(count(*)) over (partition by l_suppkey), 9) as share
from lineitem group by l_suppkey, l_orderkey""")
def agg_wide_category_share(spark: SparkSession, folder: str) -> DataFrame:
    """Shares of a column with thousands of values, as one map per key."""
    shares = category_shares(fx.table(spark, folder, "lineitem"), ["l_suppkey"], "l_orderkey")
    return rounded(shares.select("l_suppkey", F.explode("shares").alias("value", "share")), 9)


@query("cull_by_runs", fx.FX + """
select o_orderkey, (o_orderpriority = '1-URGENT')::int as "o_orderpriority_1-URGENT",
       (o_orderpriority = '2-HIGH')::int as "o_orderpriority_2-HIGH", 0 as o_orderpriority_nan
from fx_prev""")
def cull_by_stored_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Importances of two stored runs, their totals, the list of low ones and the smaller matrix."""
    rows = fx.prev(spark, folder)
    matrix, _, _ = one_hot(rows.select("o_orderkey", "o_orderpriority"))
    store = shared_folder(spark)
    for run in (0, 1):
        weight = F.when(F.col("o_orderpriority") < "3", 10.0 + F.col("o_totalprice")).otherwise(0.0)
        write_store(spark, f"{store}/run{run}", {"feature_importance": rows.where(
            F.col("o_orderkey") % 2 == run).select(
                F.concat(F.lit("o_orderpriority_"), "o_orderpriority").alias("feature"),
                weight.alias("importance"), (F.col("o_custkey") % 5).alias("fold"))})
    return cull_by_runs(matrix, store, ["run0", "run1", "missing"], keep=["o_orderkey"])[0]


@query("reduce_svd")
def reduce_svd(spark: SparkSession, folder: str) -> DataFrame:
    return _reduced(spark, folder, "SVD", "TruncatedSVD", {"n_components": 4})


@query("reduce_pca")
def reduce_pca(spark: SparkSession, folder: str) -> DataFrame:
    return _reduced(spark, folder, "PCA", "IncrementalPCA", {"n_components": 4})


@query("reduce_lda")
def reduce_lda(spark: SparkSession, folder: str) -> DataFrame:
    return _reduced(spark, folder, "LDA", "LatentDirichletAllocation",
                    {"n_components": 4, "max_iter": 3, "random_state": 42})


@query("reduce_nmf")
def reduce_nmf(spark: SparkSession, folder: str) -> DataFrame:
    return _reduced(spark, folder, "NMF", "NMF", {"n_components": 3, "max_iter": 5})


@query("reduce_random_projection")
def reduce_random_projection(spark: SparkSession, folder: str) -> DataFrame:
    return _reduced(spark, folder, "RP", "GaussianRandomProjection", {"n_components": 4})
