"""Registered queries, each with the SQL it must equal where SQL can say it."""

from importlib import import_module

MODULES = ("scans", "aggregates", "expressions", "errors", "linear", "learned")


def load_all():
    for m in MODULES:
        import_module(f"{__name__}.{m}")
    from ride_analytics.registry.base import ORACLES, QUERIES
    return QUERIES, ORACLES
