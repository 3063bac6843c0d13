"""Check and bench queries over the given tables."""

from __future__ import annotations

import importlib

from cartomark.workload import registry

MODULES = (
    "spatial_queries",
    "scan_queries",
    "join_queries",
    "aggregate_queries",
    "text_queries",
    "geo_queries",
    "job_queries",
)


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"cartomark.workload.{name}")


def all_queries() -> dict[str, registry.Query]:
    _load()
    return dict(registry.QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(registry.ORACLES)
