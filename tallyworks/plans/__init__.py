"""Registered queries, one module per part of the library."""

from importlib import import_module

MODULES = ["sources", "frame", "summaries", "ordered", "scalars", "features", "learning", "texts", "graphs", "rewards", "streams"]


def load():
    """The registry with all queries in it."""
    for module in MODULES:
        import_module(f"tallyworks.plans.{module}")
    return import_module("tallyworks.plans.registry")
