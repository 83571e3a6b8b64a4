"""Registered queries: each Spark query side by side with its oracle SQL."""

from __future__ import annotations

from importlib import import_module

from emberline.plans.registry import Query

_MODULES = ["review_queries", "user_queries", "catalog_queries", "profile_queries"]


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for module in _MODULES:
        for name, query in import_module(f"{__name__}.{module}").QUERIES.items():
            if name in found:
                raise ValueError(f"query registered twice: {name}")
            found[name] = query
    return found
