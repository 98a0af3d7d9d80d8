"""Registered queries: every operator over the provided tables, with the SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

from pollfold.queries.registry import ORACLES, QUERIES

for _module in ("scans", "shaping", "scalars", "joining", "aggregating", "ordering", "jobs", "streams"):
    import_module(f"pollfold.queries.{_module}")

__all__ = ["ORACLES", "QUERIES"]
