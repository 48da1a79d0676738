"""Table sources and sinks: CSV sets, a Parquet table store, predictions, parameters."""

from __future__ import annotations

import json
import logging
import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from featherloom.naming import quoted, run_folder
from featherloom.operators.clean import normalise_missing
from featherloom.parallel import run_parallel
from featherloom.report import Report, ensure

log = logging.getLogger("featherloom")

_EMPTY = T.StructType([])
_LISTING = "table string, folder string"


def shared_folder(spark: SparkSession) -> str:
    """A new folder for tables written between steps.

    It lies under ``spark.checkpoint.dir``. Where the session names none, only
    a local master may fall back to the machine's temporary folder.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.mkdtemp(prefix="featherloom-")
    return f"{root.rstrip('/')}/featherloom-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop)


def _children(spark: SparkSession, path: str) -> list[str]:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop) if s.isDirectory())


def _remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def empty_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], _EMPTY)


def load_tables(spark: SparkSession, paths: Mapping[str, str],
                schemas: Mapping[str, T.StructType] | None = None,
                report: Report | None = None) -> dict[str, DataFrame]:
    """Named CSV (or ``.parquet``) files; a missing file is skipped and reported.

    Give ``schemas`` at scale: inferring one reads the whole file once more.
    """
    report = ensure(report)
    out = {}
    for name, path in paths.items():
        if not path_exists(spark, path):
            report.skip("load_tables", name, f"no file {path}")
            continue
        if path.rstrip("/").endswith(".parquet"):
            df = spark.read.parquet(path)
        else:
            reader = spark.read.option("header", True)
            schema = (schemas or {}).get(name)
            reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
            df = reader.csv(path)
        out[name] = normalise_missing(df)
    return out


def input_paths(folder: str, inputs: Mapping[str, Mapping]) -> dict[str, str]:
    """File paths of ``{table: {name, index}}`` input specs."""
    return {t: f"{folder}/{spec['name']}" for t, spec in inputs.items()}


def input_keys(inputs: Mapping[str, Mapping]) -> dict[str, str | None]:
    return {t: spec.get("index") for t, spec in inputs.items()}


def write_store(spark: SparkSession, path: str, tables: Mapping[str, DataFrame],
                overwrite: bool = True, fast: bool = False,
                partition_by: Mapping[str, str] | None = None) -> bool:
    """One Parquet sub-directory per table; False if it exists and may not be replaced.

    ``fast`` prefers speed to size (snappy rather than zstd). Tables already in
    the store but not in ``tables`` leave it. Every write goes to new folders; the
    listing follows last, and the folders it named before are removed after it, so a
    job that dies leaves the old tables, or a store that counts as missing.
    """
    version = uuid.uuid4().hex[:12]
    if path_exists(spark, path):
        if not overwrite:
            log.warning("store %s exists, overwrite is not allowed", path)
            return False
    codec = "snappy" if fast else "zstd"

    def one(name: str, df: DataFrame) -> Callable[[], None]:
        def write() -> None:
            writer = df.write.mode("overwrite").option("compression", codec)
            if partition_by and name in partition_by:
                writer = writer.partitionBy(partition_by[name])
            writer.parquet(f"{path}/{name}-{version}")
        return write

    before = _listing(spark, path)

    run_parallel([one(n, df) for n, df in tables.items()])
    listing = spark.createDataFrame([(n, f"{n}-{version}") for n in tables], _LISTING)
    listing.coalesce(1).write.mode("overwrite").json(f"{path}/_tables")
    for folder in before.values():
        _remove(spark, f"{path}/{folder}")
    return True


def _listing(spark: SparkSession, path: str) -> dict[str, str]:
    """Folder of every table; a store without a listing has none."""
    if not path_exists(spark, f"{path}/_tables"):
        return {}
    rows = spark.read.schema(_LISTING).json(f"{path}/_tables").collect()
    have = set(_children(spark, path))
    return {r["table"]: r["folder"] for r in rows if r["folder"] in have}


def stored_names(spark: SparkSession, path: str) -> list[str]:
    return sorted(_listing(spark, path))


def read_store(spark: SparkSession, path: str, tables: Sequence[str] | None = None,
               ) -> dict[str, DataFrame]:
    """All or the named tables; a missing name, or store, gives empty tables."""
    have = _listing(spark, path)
    wanted = sorted(have) if tables is None else list(tables)
    return {t: spark.read.parquet(f"{path}/{have[t]}") if t in have else empty_table(spark)
            for t in wanted}


def describe_store(spark: SparkSession, path: str) -> DataFrame:
    """table_name, n_rows, n_columns and estimated bytes of every stored table."""
    summaries = [_summary(name, df) for name, df in read_store(spark, path).items()]
    if not summaries:
        return spark.createDataFrame(
            [], "table_name string, n_rows bigint, n_columns int, n_bytes bigint")
    out = summaries[0]
    for s in summaries[1:]:
        out = out.unionByName(s)
    return out


def _summary(name: str, df: DataFrame) -> DataFrame:
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"),
        F.lit(size).cast("bigint").alias("n_bytes"))


def any_empty(tables: Mapping[str, DataFrame] | Sequence[DataFrame]) -> bool:
    """True if there are no tables or one has no rows."""
    frames = list(tables.values()) if isinstance(tables, Mapping) else list(tables)
    return not frames or any(not df.columns or df.isEmpty() for df in frames)


def write_predictions(df: DataFrame, path: str, key: str, proba: str,
                      overwrite: bool = True) -> str:
    """Key and probability as CSV part files with a header."""
    mode = "overwrite" if overwrite else "errorifexists"
    (df.select(quoted(key), quoted(proba)).write.mode(mode)
     .option("header", True).csv(path))
    return path


def write_meta_features(spark: SparkSession, folder: str, prefix: str, run: str,
                        train: DataFrame, test: DataFrame, level: int = 1) -> list[str]:
    """Stores the pair under the run name and again as the latest of its level."""
    kind = "meta_features" if level == 1 else "meta_stackers"
    versioned = f"{folder}/{prefix}_{run_folder(run)}_{kind}"
    latest = f"{folder}/{prefix}_{kind}"
    write_store(spark, versioned, {"train_meta": train, "test_meta": test})
    # the second copy reads the written tables, so nothing is computed twice
    write_store(spark, latest, read_store(spark, versioned))
    return [versioned, latest]


def save_params(spark: SparkSession, folder: str, task: str, params: Mapping,
                score: float | None = None, iteration: int | None = None,
                remove_old: bool = True) -> str:
    """Saves parameters of a task as one JSON row; ``iteration`` keeps a copy apart."""
    name = "best" if iteration is None else f"iteration_{iteration:04d}"
    path = f"{folder}/{task}/{name}"
    row = [(task, score, iteration, json.dumps(dict(params), sort_keys=True))]
    df = spark.createDataFrame(row, "task string, score double, iteration int, params string")
    mode = "overwrite" if remove_old else "append"
    df.coalesce(1).write.mode(mode).parquet(path)
    return path


def load_params(spark: SparkSession, folder: str, task: str) -> dict:
    """Best-scored parameters of a task; an unknown task gives {}."""
    path = f"{folder}/{task}/best"
    if not path_exists(spark, path):
        return {}
    row = (spark.read.parquet(path)
           .agg(F.max_by("params", F.coalesce("score", F.lit(float("-inf")))).alias("p"))
           .first())
    return json.loads(row["p"]) if row and row["p"] else {}
