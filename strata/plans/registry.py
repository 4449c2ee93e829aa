"""Query registry: ``@query(name, sql)`` records a query and its oracle SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

MODULES = (
    "strata.plans.dws",
    "strata.plans.dwd",
    "strata.plans.state",
    "strata.plans.ods",
    "strata.plans.profile",
    "strata.plans.moderation",
    "strata.plans.comments",
    "strata.plans.utility",
)


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``sql`` is the DuckDB oracle (None: rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def load_all() -> dict[str, QueryFn]:
    for m in MODULES:
        importlib.import_module(m)
    return QUERIES
