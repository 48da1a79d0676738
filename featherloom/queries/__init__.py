"""Registered queries over the driver tables, each beside its SQL twin."""

from __future__ import annotations

import importlib

from featherloom.queries.registry import ORACLES, QUERIES

FAMILIES = ("sources", "projections", "joins", "aggregations", "ranking", "encoders",
            "splits", "models", "builds")

for _family in FAMILIES:
    importlib.import_module(f"featherloom.queries.{_family}")

__all__ = ["ORACLES", "QUERIES"]
