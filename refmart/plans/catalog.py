"""Query registry: one named query per inventory id, each with its DuckDB twin.

Every query reads the driver tables through the analogue fixtures and runs
over whole tables. Column names are aliased identically on both sides.
Decimals are returned as doubles and ratios rounded to 6 places so the value
digest is engine-independent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from . import q_warehouse, q_reports, q_core  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
