"""Registry of the queries exposed through ``__spark_entry__``.

Every entry reads the given tables (or frames Spark derives from them) in full, runs one
operator family of the engine, and -- where the semantics are SQL-expressible -- carries an
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    ids: str
    build: QueryFn
    oracle: str | None  # DuckDB SQL over the pre-registered tables, or None (rows-only check)


REGISTRY: dict[str, Query] = {}


def register(name: str, ids: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, ids, fn, oracle)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    """Import the modules that register queries (idempotent)."""
    from tidemark.plans import (  # noqa: F401
        queries_temporal, queries_balance, queries_clean, queries_report, queries_profile, queries_audit, queries_files,
    )
    return REGISTRY
