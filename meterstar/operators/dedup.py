"""Deduplication and ranking (WN-1..3, SRT-*, FLT-11/12).

* ``keep_first``: ROW_NUMBER() = 1 per key under a caller-given *total* order. The ``rn = 1``
  filter is planned as a WindowGroupLimit, which Spark also runs *before* the shuffle, so each
  map task keeps one row per key: a key holding a third of all rows is reduced map-side and the
  post-shuffle task sees one row per map partition for it.
* ``top_n``: global ORDER BY ... LIMIT n -> TakeOrderedAndProject (per-partition top-n, then a
  merge of n rows per partition); never a single-partition window.
* ``lowest_with_ties`` / ``highest_with_ties``: DENSE_RANK() = 1 without a global window: the
  extreme value is a one-row aggregate, joined back (broadcast of one row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _order(cols: Sequence[ColumnOrName]) -> list[Column]:
    return [F.col(c).asc() if isinstance(c, str) else c for c in cols]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName]) -> DataFrame:
    """QUALIFY ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) = 1.

    ``order`` must be total within a key (append tie-break columns); otherwise the survivor is
    arbitrary, which is the defect this operator exists to avoid.
    """
    if not order:
        raise ValueError("keep_first needs an explicit order (with tie-breaks) to be deterministic")
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def top_n(df: DataFrame, order: Sequence[ColumnOrName], n: int = 1) -> DataFrame:
    """ORDER BY order LIMIT n (WN-2, SRT-1/3/4)."""
    return df.orderBy(*_order(order)).limit(n)


def _with_ties(df: DataFrame, metric: str, pick) -> DataFrame:
    best = df.agg(pick(metric).alias("__best"))   # a global aggregate: exactly one row to broadcast
    return df.join(F.broadcast(best), F.col(metric) == F.col("__best"), "inner").drop("__best")


def lowest_with_ties(df: DataFrame, metric: str) -> DataFrame:
    """WN-3: rows whose ``metric`` equals the minimum (DENSE_RANK ascending = 1)."""
    return _with_ties(df, metric, F.min)


def highest_with_ties(df: DataFrame, metric: str) -> DataFrame:
    return _with_ties(df, metric, F.max)


def rank_dense(df: DataFrame, partition: Sequence[str], order: Sequence[ColumnOrName], name: str = "rnk") -> DataFrame:
    """Plain DENSE_RANK over a partitioned window (for per-key rankings; never unpartitioned)."""
    if not partition:
        raise ValueError("an unpartitioned window runs in one task; use lowest_with_ties / top_n")
    return df.withColumn(name, F.dense_rank().over(Window.partitionBy(*partition).orderBy(*_order(order))))
