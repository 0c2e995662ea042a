"""Every operator as a runnable query over the star-schema tables, with its SQL counterpart."""

from __future__ import annotations

import importlib

from siftwork.catalog.base import ORACLES, QUERIES

for _module in (
    "flagship",
    "scans",
    "filters",
    "missing",
    "outliers",
    "labels",
    "encoding",
    "derived",
    "scaling",
    "components",
    "splits",
    "models",
    "explore",
    "runs",
    "streams",
):
    importlib.import_module(f"siftwork.catalog.{_module}")

__all__ = ["ORACLES", "QUERIES"]
