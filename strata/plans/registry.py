"""Query registry: each query key maps to a Spark builder and, where the
result is SQL-expressible, the DuckDB SQL that must produce the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so their queries register."""
    import importlib
    for mod in PLAN_MODULES:
        importlib.import_module(f"strata.plans.{mod}")


PLAN_MODULES = ["events", "songs", "employees", "ingest", "versions", "streams", "quality",
                "kpi", "modeling", "sql_forms"]
