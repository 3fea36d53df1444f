"""Registered queries: one per operator, over the test tables, each with its SQL counterpart."""

from __future__ import annotations

from importlib import import_module

# Modules that register queries when imported.
MODULES = ("analytics", "exploration", "profiling", "quality", "relational", "scalars", "builders", "loading")


def load_queries():
    """All registered queries by id."""
    for name in MODULES:
        import_module(f"starloom.catalog.{name}")
    from starloom.catalog.registry import QUERIES

    return QUERIES
