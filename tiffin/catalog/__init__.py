"""All registered queries."""

import importlib

MODULES = [
    "projections", "scalars", "joining", "aggregates", "windows", "history", "tables", "storage", "functions", "streams", "jobs",
]


def load():
    """Import every query module; returns the queries and the SQL of those that have some."""
    for module in MODULES:
        importlib.import_module(f"tiffin.catalog.{module}")
    from tiffin.catalog import registry

    return registry.QUERIES, registry.ORACLES
