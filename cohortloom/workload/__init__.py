"""All named queries, gathered from the query modules."""

from __future__ import annotations

from importlib import import_module

MODULES = ("key_queries", "flow_queries", "report_queries")


def _load() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")


def all_queries() -> dict:
    from cohortloom.workload.registry import QUERIES

    _load()
    return QUERIES


def all_oracles() -> dict:
    from cohortloom.workload.registry import ORACLES

    _load()
    return ORACLES
