"""Load strategies (SNK-5..11, SNK-21/22) as DataFrame transformations, and loads into tables.

Each strategy is a *pure* function ``(target, source) -> new table contents`` built from joins and
unions, so it can be planned, explained and checked against SQL. ``materialize`` writes the result
into a table (``tables.TableFolder`` or ``tables.CatalogTable``): append, a whole new version, or only
the partition folders that a load touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.operators.dedup import keep_first
from meterstar.operators.tables import PART, CatalogTable, TableFolder  # noqa: F401 - part of this module's interface
from meterstar.session import drop_materialized, materialized

# --- strategy semantics ---------------------------------------------------------------------------


def _target_keys(target: DataFrame, key: Sequence[str]) -> DataFrame:
    # distinct = partial aggregation: repeated (hot) keys collapse map-side before the shuffle
    return target.select(*[F.col(k).alias(f"__t_{k}") for k in key]).distinct()


def _anti(left: DataFrame, right_keys: DataFrame, key: Sequence[str]) -> DataFrame:
    # equality, so a NULL key never matches (MERGE ... ON T.k = S.k); AQE splits a skewed side
    cond = None
    for k in key:
        c = left[k] == right_keys[f"__t_{k}"]
        cond = c if cond is None else cond & c
    return left.join(right_keys, cond, "left_anti")


def new_rows(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Source rows whose key is absent from the target (the rows an insert-only MERGE adds).

    Repeated keys *inside* the source are all kept, as the warehouse MERGE does. The target is reduced
    to its distinct keys on the map side; AQE picks the join from measured sizes.
    """
    return _anti(source, _target_keys(target, key), key)


def insert_new(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """SNK-6: MERGE ... WHEN NOT MATCHED THEN INSERT -> target plus new source rows."""
    return target.unionByName(new_rows(target, source, key).select(*target.columns))


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str], order: Sequence | None = None) -> DataFrame:
    """SNK-7: keyed merge. Target rows whose key is in the source are replaced by the source row.

    A key repeated in the source is ambiguous for MERGE; ``order`` picks the surviving source row
    (first under the order). Without ``order`` every source row is kept, i.e. ``delete_insert``.
    """
    if order:
        # only keyed rows are reduced: a NULL key never matches, so every such row is inserted
        has_key = None
        for k in key:
            c = F.col(k).isNotNull()
            has_key = c if has_key is None else has_key & c
        source = keep_first(source.where(has_key), key, order).unionByName(source.where(~has_key))
    return delete_insert(target, source, key)


def delete_insert(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """SNK-11: delete target rows whose key occurs in the source, insert *all* source rows."""
    kept = _anti(target, _target_keys(source, key), key)
    return kept.unionByName(source, allowMissingColumns=True)


def in_window(c: str, start, end) -> Column:
    """``start <= c < end``; None leaves that side open (an open window still needs a value)."""
    out = F.col(c).isNotNull()
    if start is not None:
        out = out & (F.col(c) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        out = out & (F.col(c) < F.lit(end).cast("timestamp_ntz"))
    return out


def replace_interval(target: DataFrame, source: DataFrame, column: str, start, end) -> DataFrame:
    """SNK-10: delete target rows with ``start <= column < end`` and insert the source rows of that
    window. A window day with no source rows ends up empty (it is deleted, not left as it was)."""
    keep = target.where(~in_window(column, start, end) | F.col(column).isNull())
    return keep.unionByName(source.where(in_window(column, start, end)).select(*target.columns))


def high_water_rows(source: DataFrame, target: DataFrame | None, column: str, lookback: str | None = None) -> DataFrame:
    """SNK-8: rows newer than the target's maximum of ``column`` (strict ``>``).

    An empty / missing target (max NULL) takes every row. ``lookback`` (an interval string such as
    '2 hours') widens the filter to re-take late and tied rows; combine with ``upsert`` so the
    re-taken rows replace rather than duplicate. The maximum is a one-row aggregate (partial per
    task), used as a scalar subquery.
    """
    if target is None:
        return source
    hw = target.select(F.max(column)).scalar()
    bound = hw - F.expr(f"INTERVAL {lookback}") if lookback else hw
    return source.where(hw.isNull() | (F.col(column) > bound))


def add_new_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """SNK-9 (append_new_columns): union by name; columns new in the source are added (old rows
    NULL), columns missing from the source stay (NULL for the new rows). Nothing is dropped."""
    return target.unionByName(source, allowMissingColumns=True)


# --- loads into tables -------------------------------------------------------------------------------

STRATEGIES = ("view", "table", "append", "insert_new", "merge", "delete_insert", "time_interval")


PERIODS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}


def folder_range(start, end, period: str) -> Column:
    """Folders that ``start <= time < end`` can lie in, where folder names are days or months of that time.

    The bounds are constants of the plan, so it is a static partition filter.
    """
    hit = F.col(PART).isNotNull()
    if start is not None:
        hit = hit & (F.col(PART) >= F.date_format(F.lit(start).cast("timestamp_ntz"), PERIODS[period]))
    if end is not None:
        last = F.lit(end).cast("timestamp_ntz") - F.expr("INTERVAL 1 MICROSECOND")
        hit = hit & (F.col(PART) <= F.date_format(last, PERIODS[period]))
    return hit


def materialize(spark: SparkSession, df: DataFrame, strategy: str, table: TableFolder | None = None,
                name: str | None = None, key: Sequence[str] = (), order: Sequence | None = None,
                incremental_key: str | None = None, window: tuple | None = None, period: str | None = None,
                high_water: str | None = None, lookback: str | None = None, full_refresh: bool = False,
                moves: bool = True):
    """SNK-21/22: one entry point over the strategies.

    ``view`` registers a temp view (lazy); the others write into ``table``. ``full_refresh`` rebuilds
    the table from ``df`` whatever the strategy. ``high_water`` (a column) keeps only rows newer than
    the table's maximum first (SNK-8). ``time_interval`` takes only rows inside its window, on the
    first run as on every other. The delivery is staged once, so its plan runs once however many joins
    read it.

    On a partitioned table, merge / delete_insert / time_interval read and rewrite only the folders that the
    load touches. For a keyed load these are the delivery's folders, and those where its keys lie now,
    for which the table's keys are read; ``moves=False`` says that a key never changes its folder (the
    folder column depends on the key) and saves that. For a window they follow from its bounds, if
    ``period`` ('day' or 'month') says that folders are named by that period of ``incremental_key`` (or of
    ``high_water``, whose maximum then lies in the last folder).
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; one of {STRATEGIES}")
    if strategy == "view":
        df.createOrReplaceTempView(name or "view")
        return df
    if table is None:
        raise ValueError("a table folder is needed for persisted strategies")
    if strategy == "time_interval":
        if not incremental_key or not window:
            raise ValueError("time_interval needs incremental_key and window=(start, end)")
        df = df.where(in_window(incremental_key, *window))
    target = None if full_refresh else table.read()
    if target is None or strategy == "table":
        table.replace(df)
        return None
    if high_water:
        df = high_water_rows(df, table.newest() if period else target, high_water, lookback)
    if strategy == "append":
        table.append(df)
        return None
    df = materialized(df, "delivery")
    if strategy == "insert_new":
        added = materialized(new_rows(target, df, key).select(*target.columns), "added")  # reads the table it extends
        table.append(added)
        drop_materialized(added)
    else:
        parts = None
        if table.partition_by:
            folder = table.folder_of(F.col(table.partition_by)).alias(PART)
            parts = df.select(folder)
            if strategy == "time_interval":
                old = table.scan()
                hit = old.where(folder_range(*window, period) if period else in_window(incremental_key, *window))
                parts = parts.unionByName(hit.select(PART))
            elif moves:
                # a key may lie in another folder: its old row must go too
                parts = parts.unionByName(table.scan().join(df.select(*key).distinct(), list(key), "left_semi").select(PART))
            parts = materialized(parts.distinct(), "parts")
            listed = table.names(parts)
            target = table.touched(parts if listed is None else listed)
        if strategy == "merge":
            # on_schema_change = append_new_columns: widen the target, never drop a column
            result = upsert(add_new_columns(target, df.limit(0)), df, key, order)
        elif strategy == "delete_insert":
            result = delete_insert(target, df, key)
        else:
            result = replace_interval(target, df, incremental_key, *window)
        if parts is None:
            table.replace(result)
        else:
            table.replace_folders(result, parts if listed is None else listed)
            drop_materialized(parts)
    drop_materialized(df)
    return None


# --- physical layouts ------------------------------------------------------------------------------


def write_files(df: DataFrame, path: str, n: int, mode: str = "error") -> None:
    """SNK-1: rewrite as ``n`` Parquet parts (round-robin repartition, no key skew possible).

    ``n`` is the number of writing tasks, so it must follow the size of the data; ``parts_for`` gives it.
    """
    df.repartition(n).write.mode(mode).parquet(path)


def parts_for(input_bytes: int, part_mb: int = 256, least: int = 4) -> int:
    """Number of parts of about ``part_mb`` each, ``least`` at small sizes."""
    return max(least, -(-input_bytes // (part_mb << 20)))


def write_partitioned(df: DataFrame, path: str, ts_col: str, date_col: str = "pickup_date",
                      cluster_by: Sequence[str] = (), files_per_write: int | None = None,
                      mode: str = "error", granularity: str = "day") -> None:
    """SNK-12/13: date-partitioned (and clustered) table.

    Rows are range-partitioned on (date, cluster columns, row hash) and sorted within tasks on
    (date, cluster columns): each task writes few date folders, row groups are tight on the cluster
    columns (min/max skipping), and the deterministic row hash lets a date / vendor holding a third
    of all rows spread over many tasks -- a task retry recomputes the same split.
    ``granularity`` = day (one folder per day) or month / year (the folder holds the period start).
    """
    day = F.to_date(F.col(ts_col))
    out = df.withColumn(date_col, day if granularity == "day" else F.trunc(day, granularity))
    salt = F.xxhash64(*[F.col(c) for c in df.columns])
    keys = [F.col(date_col), *[F.col(c) for c in cluster_by], salt]
    out = (out.repartitionByRange(files_per_write, *keys) if files_per_write else out.repartitionByRange(*keys))
    out.sortWithinPartitions(date_col, *cluster_by).write.mode(mode).partitionBy(date_col).parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """SNK-13: a named table at ``path``, hashed and sorted by ``keys`` into ``buckets`` files.

    Joins and aggregates on the keys read it without an exchange, as long as both sides of a join have the same
    number of buckets. For keys of many values (order ids): one value's rows, NULL included, share a file.
    """
    (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def pruned_range(ts_col: str, start, end, date_col: str = "pickup_date", granularity: str = "day",
                 inclusive_end: bool = False) -> Column:
    """Predicate on a timestamp plus the implied predicate on its date partition column, so the
    scan prunes partitions (Spark does not derive the partition filter from the timestamp).
    Half-open ``[start, end)`` unless ``inclusive_end``."""
    ts = F.col(ts_col)
    lo, hi = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    lo_part = lo.cast("date") if granularity == "day" else F.trunc(lo.cast("date"), granularity)
    upper = (ts <= hi) if inclusive_end else (ts < hi)
    return (ts >= lo) & upper & (F.col(date_col) >= lo_part) & (F.col(date_col) <= hi.cast("date"))
