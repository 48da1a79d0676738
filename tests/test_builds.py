"""Store, stages and the spec-driven build."""

from pyspark.sql import functions as F

from featherloom.plans.build import build_train_test, staged_build
from featherloom.plans.loan_like import KEY, SPECS, TARGET
from featherloom.queries import fixtures as fx
from featherloom.queries.builds import raw_tables
from featherloom.report import Report
from featherloom.sources.store import (
    any_empty, describe_store, empty_table, read_store, shared_folder, write_meta_features,
    write_store)


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_store(spark, folder):
    path = shared_folder(spark)
    assert read_store(spark, path, ["a"])["a"].columns == []
    main = fx.main(spark, folder)
    assert write_store(spark, path, {"main": main, "extra": main.limit(3)})
    assert not write_store(spark, path, {"main": main}, overwrite=False)
    assert write_store(spark, path, {"main": main.select("c_custkey")}, fast=True)
    assert list(read_store(spark, path)) == ["main"]
    assert describe_store(spark, path).select("table_name", "n_rows", "n_columns").first() == \
        ("main", main.count(), 1)
    assert any_empty({}) and any_empty([main, empty_table(spark)]) and not any_empty([main])
    paths = write_meta_features(spark, shared_folder(spark), "p", "run", main, main)
    assert all(rows(read_store(spark, p)["train_meta"]) == rows(main) for p in paths)


def test_every_stage_gives_the_same_matrix(spark, folder):
    path, report = shared_folder(spark), Report()
    args = (SPECS, KEY, TARGET, lambda: raw_tables(spark, folder))
    first = staged_build(spark, "from_train_test", "s", path, *args, report=report)
    assert report.names("staged_build") == ["train_test", "processed", "raw"]
    want = {h: rows(df) for h, df in first.items()}
    for level in ("from_train_test", "from_processed", "from_raw_cache"):
        again = staged_build(spark, level, "s", path, *args)
        assert {h: rows(df) for h, df in again.items()} == want
    plain = build_train_test(raw_tables(spark, folder), SPECS, KEY, TARGET)
    for half in ("train", "test"):
        assert plain[half].columns == again[half].columns
        counts = [df.agg(F.count("PREV_cents_SUM"), F.count("*")).first()
                  for df in (plain[half], again[half])]
        assert counts[0] == counts[1]


def test_build_reports_what_it_skips(spark, folder):
    report = Report()
    build_train_test(raw_tables(spark, folder), SPECS, KEY, TARGET, report)
    assert report.names("interaction") == ["ABSENT"]
    assert report.names("aggregate") == ["PREV_NONE"]
