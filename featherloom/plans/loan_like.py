"""Specs in the loan-data shape for the driver tables."""

from __future__ import annotations

KEY, TARGET = "c_custkey", "target"


def _orders_of(status: str, header: str) -> dict:
    return {"header": header, "data": "prev", "groupby": [KEY], "count": True, "cat": [],
            "subset": {"column_name": f"status_{status}", "conditions": [1]},
            "num": {"cents": ["min", "max", "mean"]}}


SPECS: dict = {
    "main": {
        "train": "main",
        "filter_rows": {"segment": ["MACHINERY"]},
        "factorize_columns": ["grade"],
        "onehot_encoding": True,
        "onehot_columns": [],
        "nan_as_category": True,
        "replace_rows": {"days_x": {365243: None}},
        "interaction_columns": [
            {"name": "DAYS_TO_NATION", "mode": "divide", "a": "days_x", "b": "c_nationkey"},
            {"name": "DAYS_DIFF", "mode": "subtract_positive", "a": "days_x", "b": "c_nationkey"},
            {"name": "ABSENT", "mode": "add", "a": "days_x", "b": "no_such_column"}],
        "deep_interactions": [
            {"header": "ROW", "transform": ["sum", "mean"],
             "columns": ["days_x", "c_nationkey"]}],
        "decomposition": [],
    },
    "histories": {
        "prev": {
            "onehot_encoding": True,
            "onehot_columns": ["status"],
            "nan_as_category": True,
            "replace_rows": {},
            "interaction_columns": [
                {"name": "CENTS_PER_KEY", "mode": "subtract", "a": "cents", "b": "o_orderkey"}],
            "children": {"balance": {"onehot_columns": ["l_returnflag"]}},
            "aggregations": [
                {"header": "BAL", "data": "balance", "groupby": ["o_orderkey"], "count": True,
                 "cat": ["mean"], "num": {"l_quantity": ["min", "max", "size"]}},
                {"header": "PREV", "data": "prev", "groupby": [KEY], "cat": ["mean"],
                 "num": {"cents": ["min", "max", "mean", "sum"], "CENTS_PER_KEY": ["max"],
                         "BAL_l_quantity_MIN": ["min"], "BAL_l_quantity_SIZE": ["mean", "sum"],
                         "BAL_l_returnflag_A_MEAN": ["mean", "sum"]}},
                _orders_of("F", "PREV_F"),
                _orders_of("O", "PREV_O"),
                _orders_of("NONE", "PREV_NONE")],
        },
        "activity": {
            "table": "events",
            "onehot_encoding": True,
            "onehot_columns": ["event_type"],
            "nan_as_category": True,
            "aggregations": [
                {"header": "EV", "data": "events", "groupby": [KEY], "count": True,
                 "cat": ["sum"], "num": {"value": ["min", "max", "mean", "var"],
                                         "event_id": ["size"]}}],
        },
    },
}
