"""All registered queries and their SQL oracles.

A query module registers functions (spark, sf_dir) -> DataFrame under names that start with the ids of
the survey's operators, together with DuckDB SQL for the same rows. Doubles are rounded to 6 places.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable], Callable]:
    """Registers the decorated function, and its oracle if SQL can express it."""

    def put(function: Callable) -> Callable:
        if name in QUERIES:
            raise ValueError(f"{name} is registered already")
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return put


for _module in ("scalars", "register", "spatial", "catalogue", "pixels", "threshold", "trajectory", "context", "summary", "export", "incremental", "sources"):
    import_module(f".q_{_module}", __package__)
