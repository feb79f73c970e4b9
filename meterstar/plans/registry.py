"""Named queries: name -> (spark, sf_dir) -> DataFrame, plus the equivalent DuckDB SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
INVENTORY: dict[str, str] = {}   # query name -> SURVEY ids it exercises


def query(name: str, sql: str | None = None, covers: str = ""):
    """Register a query; ``sql`` is its oracle (omit only for non-SQL-expressible work)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        INVENTORY[name] = covers
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so their queries register."""
    from meterstar.plans import (  # noqa: F401
        interval, landing, layouts, loads, nested, quality_checks, reports, stream_jobs, warehouse)
