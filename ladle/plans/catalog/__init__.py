"""Registered queries: each entry names a Spark query over the given tables and, where SQL can say it, its check."""

from __future__ import annotations

from importlib import import_module

from ladle.plans.catalog.registry import ORACLES, QUERIES

for _m in ("ranking", "scalars", "screening", "monitoring", "texts", "learning", "files"):
    import_module(f"ladle.plans.catalog.{_m}")

__all__ = ["QUERIES", "ORACLES"]
