"""All registered queries and their checking SQL."""

from __future__ import annotations

from importlib import import_module

from deq.session import prepare

GROUPS = ["quality", "timeseries", "changes", "schemas", "streams"]


def _modules():
    return [import_module(f"deq.plans.{g}") for g in GROUPS]


def queries() -> dict:
    def bound(run):
        return lambda spark, folder: run(prepare(spark), folder)

    return {name: bound(run) for m in _modules() for name, run in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in _modules() for name, sql in m.ORACLES.items()}
