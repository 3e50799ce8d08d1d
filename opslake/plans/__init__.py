"""Registered queries: thin functions (spark, sf_dir) -> DataFrame with the SQL that must agree."""

from importlib import import_module

from opslake.plans.registry import ORACLES, QUERIES

MODULES = ("operations", "observability", "applications", "estate", "streams")


def load() -> tuple[dict, dict]:
    """Imports the modules that register queries; gives queries and SQL."""
    for name in MODULES:
        import_module(f"opslake.plans.{name}")
    return dict(QUERIES), dict(ORACLES)
