"""Mapping-driven standardisation of raw feeds (PRJ-1, PRJ-2, PRJ-4, FLT-1, FLT-9, SET-1/2).

A feed mapping is a list of ``(source, target, type, safe)``; one ``select`` renames and casts
every column, so the whole projection is a single codegen stage next to the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterstar.functions.expr import MONEY, safe_cast


class Field(NamedTuple):
    source: str
    target: str
    type: str
    safe: bool = False       # NULL instead of an error for text that does not parse


def standardize(df: DataFrame, fields: Sequence[Field], not_null: Sequence[str] = (),
                sample_window: tuple[str, str] | None = None, sample_column: str = "pickup_datetime") -> DataFrame:
    """Rename + cast ``df`` to the standard schema.

    ``not_null`` lists *source* columns that must be present (rows failing are dropped, before the
    casts, so the predicate reaches the scan). ``sample_window`` = (start, end) keeps a half-open
    slice of ``sample_column`` (the development sample, FLT-9).
    """
    for c in not_null:
        df = df.where(F.col(c).isNotNull())
    cols: list[Column] = []
    for f in fields:
        src = F.col(f.source)
        cols.append((safe_cast(src, f.type) if f.safe else src.cast(f.type)).alias(f.target))
    out = df.select(*cols)
    if sample_window is not None:
        lo, hi = sample_window
        out = out.where((F.col(sample_column) >= F.lit(lo).cast("timestamp_ntz"))
                        & (F.col(sample_column) < F.lit(hi).cast("timestamp_ntz")))
    return out


def union_feeds(frames: Sequence[DataFrame], columns: Sequence[str] | None = None,
                allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name (SET-1); ``allow_missing`` fills absent columns with NULL (SET-2)."""
    out = None
    for f in frames:
        if columns is not None:
            f = f.select(*columns)
        out = f if out is None else out.unionByName(f, allowMissingColumns=allow_missing)
    if out is None:
        raise ValueError("nothing to union")
    return out


def fill(df: DataFrame, **typed_constants: tuple) -> DataFrame:
    """PRJ-4: typed filler columns, e.g. ``fill(df, trip_type=(1, "int"), ehail_fee=(0, MONEY))``."""
    for name, (value, typ) in typed_constants.items():
        df = df.withColumn(name, F.lit(value).cast(typ))
    return df


def taxi_fields(prefix: str, green: bool) -> list[Field]:
    """Standard schema of the green (``lpep``) / yellow (``tpep``) feed."""
    fields = [
        Field("VendorID", "vendor_id", "int"),
        Field("RatecodeID", "rate_code_id", "int", safe=green),
        Field("PULocationID", "pickup_location_id", "int"),
        Field("DOLocationID", "dropoff_location_id", "int"),
        Field(f"{prefix}_pickup_datetime", "pickup_datetime", "timestamp_ntz"),
        Field(f"{prefix}_dropoff_datetime", "dropoff_datetime", "timestamp_ntz"),
        Field("store_and_fwd_flag", "store_and_fwd_flag", "string"),
        Field("passenger_count", "passenger_count", "int"),
        Field("trip_distance", "trip_distance", MONEY),
    ]
    if green:
        fields.append(Field("trip_type", "trip_type", "int", safe=True))
    money_cols = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount"]
    if green:
        money_cols.append("ehail_fee")
    money_cols += ["improvement_surcharge", "total_amount"]
    fields += [Field(c, c, MONEY) for c in money_cols]
    fields.append(Field("payment_type", "payment_type", "int", safe=green))
    return fields


FHV_FIELDS = [
    Field("PULocationID", "pickup_location_id", "int"),
    Field("DOLocationID", "dropoff_location_id", "int"),
    Field("pickup_datetime", "pickup_datetime", "timestamp_ntz"),
    Field("dropOff_datetime", "dropoff_datetime", "timestamp_ntz"),
    Field("dispatching_base_num", "dispatching_base_num", "string"),
    # The load table holds codes such as 'B00013' here; a plain cast would fail the build.
    Field("Affiliated_base_number", "affiliated_base_number", "int", safe=True),
    Field("SR_FLAG", "sr_flag", "int", safe=True),
]

UNIONED_COLUMNS = [
    "vendor_id", "rate_code_id", "pickup_location_id", "dropoff_location_id", "pickup_datetime",
    "dropoff_datetime", "store_and_fwd_flag", "passenger_count", "trip_distance", "trip_type",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
    "improvement_surcharge", "total_amount", "payment_type", "service_type",
]
