"""Dimension enrichment (JN-1..4, JN-7): lookup joins, role-playing dimensions, orphan checks.

No join is forced to broadcast and nothing is counted while a plan is built. Spark broadcasts a side
whose file size is under ``spark.sql.autoBroadcastJoinThreshold`` (zones and payment codes are at any
scale) and AQE turns a join into a broadcast, or splits a skewed one, from measured shuffle sizes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich(fact: DataFrame, dim: DataFrame, fact_key: str | Column, dim_key: str,
           columns: Mapping[str, str], how: str = "left") -> DataFrame:
    """Attach ``columns`` (dim column -> new name) of ``dim`` to ``fact`` by key.

    ``fact_key`` may be an expression (JN-2 joins on ``coalesce(payment_type, 0)``).
    The dimension is projected to the key and the wanted columns before the join.
    """
    tmp_key = f"__dimkey_{dim_key}"
    d = dim.select(F.col(dim_key).alias(tmp_key), *[F.col(src).alias(dst) for src, dst in columns.items()])
    fk = F.col(fact_key) if isinstance(fact_key, str) else fact_key
    return fact.join(d, fk == d[tmp_key], how).drop(tmp_key)


def role_playing(fact: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, str],
                 columns: Sequence[str], how: str = "left") -> DataFrame:
    """JN-3: join the same dimension once per role.

    ``roles`` maps a role prefix to the fact key, e.g. ``{"pickup": "pickup_location_id",
    "dropoff": "dropoff_location_id"}``; each dimension column ``c`` arrives as ``{role}_{c}``.
    """
    for role, fk in roles.items():
        fact = enrich(fact, dim, fk, dim_key, {c: f"{role}_{c}" for c in columns}, how)
    return fact


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """JN-7: child rows whose non-NULL key is absent from the parent (left anti join).

    The parent side is reduced to its distinct keys first (partial aggregation, so a hot key
    is collapsed map-side before any shuffle).
    """
    keys = parent.select(F.col(parent_key).alias("__pk")).distinct()
    return (child.where(F.col(child_key).isNotNull())
            .join(keys, F.col(child_key) == F.col("__pk"), "left_anti"))
