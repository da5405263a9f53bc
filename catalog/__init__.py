"""Queries over the benchmark tables, each with SQL giving the same result where SQL can."""

from importlib import import_module

MODULES = ["air", "relational", "elt", "features", "learning", "series", "generated"]


def load():
    from catalog.base import ORACLES, QUERIES

    for name in MODULES:
        import_module(f"catalog.{name}")
    return QUERIES, ORACLES
