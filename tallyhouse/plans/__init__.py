"""Registered queries, one module per part of the library."""

from importlib import import_module

MODULES = ("files", "ingest", "silver", "quality", "gold", "marts", "metrics", "fraud", "basket", "pricing", "checks", "profile", "kpis", "retrieval", "streams")


def load() -> None:
    """Import all modules, which registers their queries."""
    for name in MODULES:
        import_module(f"tallyhouse.plans.{name}")
