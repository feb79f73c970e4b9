"""File landing reads (SRC-1..9, SRC-19).

All readers return lazy DataFrames so column pruning and filter push-down reach the scan.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """SRC-1/2/3: one or many Parquet files or globs as one table; optional column subset."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def footer_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table read by the V2 scan, which answers ``COUNT(*)``, minima and maxima of numbers and dates
    from the files' footers: one row per file reaches the aggregate (``PushedAggregation`` in the plan)."""
    key = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(key)
    spark.conf.set(key, ",".join(x for x in before.split(",") if x.strip() != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(key, before)


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None,
             header: bool = True, check_header: bool = True, mode: str = "PERMISSIVE") -> DataFrame:
    """SRC-4/5/6: CSV (also .csv.gz) with a header.

    Without ``schema`` every column is a string (as the reference's Spark read). With a declared
    schema Spark matches columns by *position*, so the header of every file is checked against the
    declared names (``enforceSchema=false``): a file with renamed or reordered columns fails the read
    instead of mislabelling them. Surplus trailing columns are allowed and dropped; missing trailing
    fields of a row are NULL.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("header", header).option("mode", mode)
    if schema is None:
        return reader.csv(paths)
    if not (header and check_header):
        return reader.schema(schema).csv(paths)
    # names of one header (only a first line is read) tell the surplus columns; Spark checks all files by them
    found = spark.read.option("header", True).csv(paths).columns
    full = T.StructType(list(schema.fields) + [T.StructField(c, T.StringType()) for c in found[len(schema.fields):]])
    return reader.schema(full).option("enforceSchema", False).csv(paths).select(*schema.names)


def with_source_file(df: DataFrame, name: str = "filename", pattern: str | None = None) -> DataFrame:
    """FN-20: the landed file name of each row (``_metadata.file_name``), or what ``pattern`` (one group)
    finds in its path."""
    if pattern is None:
        return df.withColumn(name, F.col("_metadata.file_name"))
    return df.withColumn(name, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def monthly_file_names(start: str | _dt.date, end: str | _dt.date, kinds: Iterable[str],
                       pattern: str = "{kind}_tripdata_{month}.parquet") -> list[str]:
    """SRC-8/9: month starts inside [start, end] times feed kinds -> file names.

    Like a month-start date range, only first-of-month dates inside the range count.
    The list is tiny (months x kinds) and only names files; the data itself is read by Spark.
    """
    start = _dt.date.fromisoformat(str(start)[:10])
    end = _dt.date.fromisoformat(str(end)[:10])
    y, m = start.year, start.month
    if start.day != 1:
        y, m = (y + (m == 12), m % 12 + 1)
    names = []
    while _dt.date(y, m, 1) <= end:
        for kind in kinds:
            names.append(pattern.format(kind=kind, month=f"{y:04d}-{m:02d}"))
        y, m = (y + (m == 12), m % 12 + 1)
    return names


def read_monthly_feeds(spark: SparkSession, root: str, start: str, end: str, kinds: Sequence[str],
                       pattern: str = "{kind}_tripdata_{month}.parquet", tag: str = "taxi_type",
                       ignore_missing: bool = False) -> DataFrame:
    """SRC-8: read every monthly file of every kind in one scan per kind, tag rows with the kind.

    Feeds of different kinds may have different columns, so each kind is one multi-path read and the
    kinds are unioned by name with missing columns as NULL (SET-2). The months of one kind may differ
    too: their schemas are merged, so a column that only some months have is kept. A month that has
    not landed fails the read unless ``ignore_missing``.
    """
    out = None
    for kind in kinds:
        names = monthly_file_names(start, end, [kind], pattern)
        if ignore_missing:
            names = [n for n in names if path_exists(spark, f"{root}/{n}")]
        if not names:
            continue
        df = spark.read.option("mergeSchema", True).parquet(*[f"{root}/{n}" for n in names]).withColumn(tag, F.lit(kind))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no month start inside the requested range")
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def generated_range(spark: SparkSession, n: int) -> DataFrame:
    """SRC-19."""
    return spark.range(n)


def tag(df: DataFrame, **constants) -> DataFrame:
    """PRJ-2/3/4: constant tag columns (typed when given as ``(value, type)``)."""
    for name, value in constants.items():
        if isinstance(value, tuple):
            col: Column = F.lit(value[0]).cast(value[1])
        elif isinstance(value, Column):
            col = value
        else:
            col = F.lit(value)
        df = df.withColumn(name, col)
    return df


def read_seed(spark: SparkSession, path: str, schema: T.StructType, primary_key: Sequence[str]) -> DataFrame:
    """SRC-7: a small CSV lookup (seed) with a declared schema and primary key.

    The key is checked (not null, unique) before the seed is used; a violation raises. The seed is
    returned lazily.
    """
    from meterstar.operators import quality as Q

    df = read_csv(spark, path, schema)
    checks = [Q.not_null(k) for k in primary_key]
    checks.append(Q.unique(primary_key[0]) if len(primary_key) == 1 else Q.unique_combination(primary_key))
    Q.enforce(Q.run_checks(df, checks))
    return df
