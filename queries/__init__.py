"""Registered queries: every operator applied to the given tables, with a SQL counterpart."""

from importlib import import_module

MODULES = ["listings", "lifecycle", "feeds", "pages", "catalogue", "jobs", "captures", "job_runs"]


def load():
    from . import registry

    for name in MODULES:
        import_module(f"{__name__}.{name}")
    return registry.QUERIES, registry.SQL
