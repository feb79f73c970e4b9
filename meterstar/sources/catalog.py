"""Named tables and views (SRC-18, SNK-3, SNK-19): models refer to each other by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from meterstar.sources import driver_tables as D

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def register_views(spark: SparkSession, sf_dir: str, names: Iterable[str] = DRIVER_TABLES) -> list[str]:
    """Register the driver tables as temp views (lazy: nothing is read until a query runs)."""
    for n in names:
        D.table(spark, sf_dir, n).createOrReplaceTempView(n)
    return list(names)


def view(df: DataFrame, name: str) -> DataFrame:
    """Materialise a model as a view (the ``view`` strategy) and return it."""
    df.createOrReplaceTempView(name)
    return df


def named(spark: SparkSession, name: str) -> DataFrame:
    """``source(...)`` / ``ref(...)``: a table or view by name from the session catalog."""
    return spark.table(name)


def external(spark: SparkSession, name: str, path: str, analyze: Iterable[str] | None = None) -> DataFrame:
    """Register Parquet files at ``path`` under a name, without a copy; ``analyze`` computes the table's size and row
    count, and the statistics of those columns, for the planner (``ANALYZE TABLE``)."""
    spark.catalog.createTable(name, path=path, source="parquet")
    if analyze is not None:
        columns = ", ".join(f"`{c}`" for c in analyze)
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS" + (f" FOR COLUMNS {columns}" if columns else ""))
    return spark.table(name)


def preview(df: DataFrame, n: int = 5):
    """SNK-20: the first ``n`` rows as a local pandas frame (bounded: LIMIT before the transfer)."""
    return df.limit(n).toPandas()
