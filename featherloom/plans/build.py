"""From specs to the train/test matrix, with cached stages."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from featherloom.ml.reduce import decompose
from featherloom.naming import dummy_name, quoted
from featherloom.operators.aggregate import aggregate_specs, carried_categories
from featherloom.operators.clean import (
    drop_rows, narrow_types, replace_values, split_labelled)
from featherloom.operators.encode import (
    MAX_CATEGORIES, discover_categories, factorize, one_hot)
from featherloom.operators.interact import interaction, row_stats_list
from featherloom.operators.joins import join_features, rollup_child, union_train_test
from featherloom.operators.schema import categorical_columns, check_columns, feature_columns
from featherloom.parallel import run_parallel
from featherloom.report import Report, ensure
from featherloom.sources.store import any_empty, load_tables, read_store, write_store


@dataclass
class Prepared:
    """A cleaned and encoded table with the names of its category columns."""

    table: DataFrame
    dummies: list[str] = field(default_factory=list)
    occurring: list[str] = field(default_factory=list)


def prepare(df: DataFrame, spec: Mapping, key: str, report: Report | None = None) -> Prepared:
    """Row-level steps of a spec: filter, codes, dummies, replacement, new columns."""
    report = ensure(report)
    df = drop_rows(df, spec.get("filter_rows", {}), report)
    if spec.get("factorize_columns"):
        df = factorize(df, spec["factorize_columns"], spec.get("order_by", key), report)
    dummies: list[str] = []
    occurring: list[str] = []
    if spec.get("onehot_encoding", False):
        fixed = spec.get("categories") or {}
        nan = spec.get("nan_as_category", False)
        asked = spec.get("onehot_columns")
        present, _ = check_columns(df, asked or categorical_columns(df))
        found = discover_categories(df, [c for c in present if c not in fixed],
                                    spec.get("max_categories", MAX_CATEGORIES))
        df, dummies, _ = one_hot(df, asked, nan, {**found, **fixed}, report)
        # values that were discovered, not declared, occur in at least one row
        occurring = [dummy_name(c, v) for c, values in found.items() for v in values]
    else:
        dummies = [c for c in categorical_columns(df) if spec.get("string_categories")]
    df = replace_values(df, spec.get("replace_rows", {}), report)
    df, _ = interaction(df, spec.get("interaction_columns", []), report)
    df = row_stats_list(df, spec.get("deep_interactions", []), report)
    return Prepared(df, dummies, occurring)


def build_main(df: DataFrame, spec: Mapping, key: str, target: str,
               report: Report | None = None, narrow: bool = False) -> DataFrame:
    """The entity table: row-level steps, then components of column groups."""
    report = ensure(report)
    df = prepare(df, spec, key, report).table
    available = df.columns
    for group in spec.get("decomposition", []):
        df = decompose(df, group, report, available)
    return narrow_types(df, keep=[key, target], report=report) if narrow else df


def build_history(tables: Mapping[str, DataFrame], spec: Mapping, name: str, key: str,
                  report: Report | None = None, narrow: bool = False) -> DataFrame:
    """One row per entity from a history table and, if any, its children.

    Aggregations whose ``data`` names another table run on that child first;
    the result joins the history by the child's own group-by key.
    """
    report = ensure(report)
    specs = list(spec.get("aggregations", [])) + list(spec.get("conditional_aggregations", []))
    align = spec.get("align", "inner")
    parent = prepare(tables[name], spec, key, report)
    own = [s for s in specs if s.get("data", name) == name]
    categories = list(parent.dummies)
    df = parent.table
    for child_name in dict.fromkeys(s["data"] for s in specs if s.get("data", name) != name):
        if child_name not in tables:
            report.skip("build_history", child_name, "absent child table")
            continue
        child_spec = {**{k: spec[k] for k in ("onehot_encoding", "nan_as_category")
                         if k in spec}, **spec.get("children", {}).get(child_name, {})}
        child = prepare(tables[child_name], child_spec, key, report)
        rolled = aggregate_specs(child.table, [s for s in specs if s.get("data") == child_name],
                                 child.dummies, align, child.occurring, report=report)
        for link, child_agg in rolled.items():
            df = rollup_child(df, child_agg, link)
            categories += carried_categories(child_agg, child.dummies)
    result = aggregate_specs(df, own, categories, align, parent.occurring, report=report)
    for other in result:
        if other != (key,):
            report.skip("build_history", name, f"aggregates on {list(other)}, not on {key}")
    if (key,) in result:
        out = result[(key,)]
    else:
        report.skip("build_history", name, "no aggregate is left")
        out = df.select(quoted(key)).dropna().distinct()
    return narrow_types(out, keep=[key], report=report) if narrow else out


def build_processed(tables: Mapping[str, DataFrame], specs: Mapping, key: str, target: str,
                    report: Report | None = None, narrow: bool = False,
                    ) -> dict[str, DataFrame]:
    """``main`` with labelled and unlabelled rows, and one feature table per history."""
    report = ensure(report)
    main = specs["main"]
    if "test" in main:
        rows = union_train_test(tables[main["train"]], tables[main["test"]])
    else:
        rows = tables[main["train"]]
    out = {"main": build_main(rows, main, key, target, report, narrow)}
    for name, spec in specs.get("histories", {}).items():
        out[name] = build_history(tables, spec, spec.get("table", name), key, report, narrow)
    return out


def join_processed(processed: Mapping[str, DataFrame], key: str, target: str) -> DataFrame:
    """Left-joins every history to the main table; columns sorted by name.

    Train and test rows go through the joins together and are split afterwards,
    so no history is scanned or shuffled once for each half.
    """
    histories = {n: df for n, df in processed.items() if n != "main"}
    joined = join_features(processed["main"], histories, key)
    features = sorted(feature_columns(joined, [key, target]))
    return joined.select(*[quoted(c) for c in (key, *features, target)])


def build_matrix(tables: Mapping[str, DataFrame], specs: Mapping, key: str, target: str,
                 report: Report | None = None, narrow: bool = False) -> DataFrame:
    """Spec dict and raw tables to the whole feature matrix, as one lazy plan."""
    return join_processed(build_processed(tables, specs, key, target, report, narrow),
                          key, target)


def build_train_test(tables: Mapping[str, DataFrame], specs: Mapping, key: str, target: str,
                     report: Report | None = None, narrow: bool = False,
                     ) -> dict[str, DataFrame]:
    """The matrix split by target into ``train`` and ``test``."""
    return _halves(build_matrix(tables, specs, key, target, report, narrow), target)


def _halves(matrix: DataFrame, target: str) -> dict[str, DataFrame]:
    train, test = split_labelled(matrix, target)
    return {"train": train, "test": test}


# Entry levels of a staged build, and the stage names on disk.
LEVELS = {"from_csv": 0, "from_raw_cache": 1, "from_processed": 2, "from_train_test": 3}
STAGES = {1: "raw", 2: "processed", 3: "train_test"}


def staged_build(spark: SparkSession, source: str, prefix: str, folder: str, specs: Mapping,
                 key: str, target: str,
                 read_raw: Callable[[], Mapping[str, DataFrame]] | Mapping[str, str],
                 report: Report | None = None, narrow: bool = True,
                 ) -> dict[str, DataFrame]:
    """Starts at the asked stage, falls back while a cache is missing or empty.

    Every stage below the one found is written again and then read back, so
    the next stage starts from stored columns rather than from the whole plan,
    and all entry levels return the same tables. ``read_raw`` is a set of
    paths or a function that returns the raw tables.
    """
    report = ensure(report)
    level = LEVELS[source]
    paths = {n: f"{folder}/cache_{prefix}_{stage}" for n, stage in STAGES.items()}

    if level == 3:
        halves = _stored_halves(spark, paths[3])
        if not any_empty(halves):
            return halves
        report.skip("staged_build", "train_test", "no cache at level 3")
        level = 2
    found: Mapping[str, DataFrame] = {}
    while level > 0:
        found = read_store(spark, paths[level])
        if not any_empty(found):
            break
        report.skip("staged_build", STAGES[level], f"no cache at level {level}")
        level -= 1
    if level == 0:
        raw = read_raw() if callable(read_raw) else load_tables(spark, read_raw, report=report)
        write_store(spark, paths[1], raw)
        found, level = read_store(spark, paths[1]), 1
    if level == 1:
        found = _write_stage(spark, paths[2],
                             build_processed(found, specs, key, target, report))
    if narrow:
        stored = dict(found)
        slim = run_parallel([partial(narrow_types, df, keep=[key, target], report=report)
                             for df in stored.values()])
        found = dict(zip(stored, slim))
    matrix = join_processed(found, key, target)
    part = F.when(quoted(target).isNull(), "test").otherwise("train")
    write_store(spark, paths[3], {"matrix": matrix.withColumn(_PART, part)},
                partition_by={"matrix": _PART})
    return _stored_halves(spark, paths[3])


# Folder column that separates the stored halves of the matrix.
_PART = "matrix_part"


def _stored_halves(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    matrix = read_store(spark, path, ["matrix"])["matrix"]
    if _PART not in matrix.columns:
        return {"train": matrix, "test": matrix}
    return {half: matrix.filter(F.col(_PART) == half).drop(_PART)
            for half in ("train", "test")}


def _write_stage(spark: SparkSession, path: str, tables: Mapping[str, DataFrame],
                 ) -> dict[str, DataFrame]:
    write_store(spark, path, tables)
    return read_store(spark, path)
