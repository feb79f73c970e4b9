"""Load-strategy queries: the warehouse hash-stage + insert-only merge (Q-M2-*), and the keyed
merge variants (SNK-6..11) evaluated as whole-table results over the trip binding.

Each query returns the *table contents after the load*, so the semantics are checked against SQL;
``operators.load.materialize`` writes the same results into Parquet folders; the ``persisted_*`` queries
load a table that way and read it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.functions import expr as X
from meterstar.operators import load as L
from meterstar.plans.registry import query
from meterstar.session import scratch_path
from meterstar.sources import catalog as C
from meterstar.sources import driver_tables as D

# Scenario: the table holds everything picked up before LOADED_UNTIL; the next delivery re-sends the last
# month already loaded and brings everything after it (and rows without a pickup time), so that target and
# delivery together are the whole feed.
LOADED_UNTIL = "1997-01-01"
DELIVERED_FROM = "1996-12-01"
YEAR_PREFIX = "1996-"
ONE_FILE = "yellow_tripdata_1997-01.csv"

HASH_COLUMNS = {"Green": ["VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID", "DOLocationID"],
                "Yellow": ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID"]}


def hashed_stage(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """Landing feed with ``unique_row_id`` (MD5 bytes of the concatenated key text, no separator)
    and the monthly ``filename`` each row arrived in."""
    prefix = "lpep" if service == "Green" else "tpep"
    raw = D.raw_taxi_feed(spark, sf_dir, service)
    fname = F.concat(F.lit(f"{service.lower()}_tripdata_"), F.date_format(f"{prefix}_pickup_datetime", "yyyy-MM"),
                     F.lit(".csv"))
    return raw.select(X.row_hash(HASH_COLUMNS[service], sep="").alias("unique_row_id"), fname.alias("filename"), "*")


def merged_feed(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """The table after merging the next delivery into everything loaded so far. Both sides push their
    pickup predicate into the binding; the target is read for its key columns only to find new rows."""
    prefix = "lpep" if service == "Green" else "tpep"
    ts = F.col(f"{prefix}_pickup_datetime")
    stage = hashed_stage(spark, sf_dir, service)
    target = stage.where(ts < F.lit(LOADED_UNTIL).cast("timestamp_ntz"))
    source = stage.where((ts >= F.lit(DELIVERED_FROM).cast("timestamp_ntz")) | ts.isNull())
    return L.insert_new(target, source, ["unique_row_id"])


def _stage_sql(service: str) -> str:
    prefix = "lpep" if service == "Green" else "tpep"
    s = service.lower()
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in HASH_COLUMNS[service])
    return f"""
{s}_stage AS (
  SELECT md5(concat({parts})) AS unique_row_id,
         '{s}_tripdata_' || strftime({prefix}_pickup_datetime, '%Y-%m') || '.csv' AS filename, *
  FROM {s}_raw),
{s}_target AS (SELECT * FROM {s}_stage WHERE {prefix}_pickup_datetime < TIMESTAMP '{LOADED_UNTIL}'),
{s}_source AS (SELECT * FROM {s}_stage WHERE {prefix}_pickup_datetime >= TIMESTAMP '{DELIVERED_FROM}'
                                        OR {prefix}_pickup_datetime IS NULL),
{s}_merged AS (
  SELECT * FROM {s}_target
  UNION ALL
  SELECT s.* FROM {s}_source s WHERE NOT EXISTS (SELECT 1 FROM {s}_target t WHERE t.unique_row_id = s.unique_row_id))"""


def _merged_sql(service: str) -> str:
    from meterstar.plans.warehouse import _raw_sql
    prefix = "lpep" if service == "Green" else "tpep"
    return D.with_sql(D.TRIPS_SQL, _raw_sql(service, prefix), _stage_sql(service))


@query("m2_merge_redelivered_months", covers="SNK-6 JN-6 FN-4 FN-5 FN-6 PRJ-2 PRJ-7",
       sql=_merged_sql("Yellow") + "SELECT filename, count(*) AS row_count FROM yellow_merged GROUP BY filename")
def m2_merge_redelivered_months(spark, sf_dir):
    return merged_feed(spark, sf_dir, "Yellow").groupBy("filename").agg(F.count(F.lit(1)).alias("row_count"))


@query("m2_yellow_rows_in_year", covers="Q-M2-3 FLT-7 AG-1", sql=_merged_sql("Yellow") + f"""
SELECT count(*) AS row_count FROM yellow_merged WHERE filename LIKE 'yellow_tripdata_{YEAR_PREFIX}%'""")
def m2_yellow_rows_in_year(spark, sf_dir):
    m = merged_feed(spark, sf_dir, "Yellow")
    return m.where(F.col("filename").like(f"yellow_tripdata_{YEAR_PREFIX}%")).agg(F.count(F.lit(1)).alias("row_count"))


@query("m2_green_rows_in_year", covers="Q-M2-4 FLT-7 AG-1", sql=_merged_sql("Green") + f"""
SELECT count(*) AS row_count FROM green_merged WHERE filename LIKE 'green_tripdata_{YEAR_PREFIX}%'""")
def m2_green_rows_in_year(spark, sf_dir):
    m = merged_feed(spark, sf_dir, "Green")
    return m.where(F.col("filename").like(f"green_tripdata_{YEAR_PREFIX}%")).agg(F.count(F.lit(1)).alias("row_count"))


@query("m2_rows_of_file", covers="Q-M2-5 FLT-7 AG-1", sql=_merged_sql("Yellow") + f"""
SELECT count(*) AS row_count FROM yellow_merged WHERE filename = '{ONE_FILE}'""")
def m2_rows_of_file(spark, sf_dir):
    m = merged_feed(spark, sf_dir, "Yellow")
    return m.where(F.col("filename") == ONE_FILE).agg(F.count(F.lit(1)).alias("row_count"))


# --- keyed merge variants over a narrow trip table ---------------------------------------------------
# key (l_orderkey, l_linenumber) repeats in the driver data, which is exactly where the variants differ.

KEY = ["l_orderkey", "l_linenumber"]
NARROW = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "pickup_datetime", "fare_amount", "payment_type"]
TARGET_UNTIL = "1999-01-01"
CHANGES_FROM = "1998-07-01"
INTERVAL = ("1998-07-01", "1998-08-01")
SOURCE_ORDER = ["pickup_datetime", "l_partkey", "l_suppkey", "fare_amount", "payment_type"]


def _narrow(spark, sf_dir, orders_join=None):
    return D.trips(spark, sf_dir, NARROW, orders_join=orders_join)


def _target(t):
    return t.where(F.col("pickup_datetime") < F.lit(TARGET_UNTIL).cast("timestamp_ntz"))


def _changes(t):
    # re-delivered rows carry a corrected fare
    later = F.col("pickup_datetime") >= F.lit(CHANGES_FROM).cast("timestamp_ntz")
    return (t.where(later | F.col("pickup_datetime").isNull())
            .withColumn("fare_amount", (F.col("fare_amount") + F.lit(1)).cast(X.MONEY)))


_NARROW_SQL = D.with_sql(D.TRIPS_SQL, f"""
narrow AS (SELECT {', '.join(NARROW)} FROM trips),
target AS (SELECT * FROM narrow WHERE pickup_datetime < TIMESTAMP '{TARGET_UNTIL}'),
changes AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, pickup_datetime,
                   CAST(fare_amount + 1 AS DECIMAL(18,3)) AS fare_amount, payment_type
            FROM narrow WHERE pickup_datetime >= TIMESTAMP '{CHANGES_FROM}' OR pickup_datetime IS NULL)""")


@query("snk_insert_new", covers="SNK-6", sql=_NARROW_SQL + """
SELECT * FROM target UNION ALL
SELECT c.* FROM changes c WHERE NOT EXISTS (
  SELECT 1 FROM target t WHERE t.l_orderkey = c.l_orderkey AND t.l_linenumber = c.l_linenumber)""")
def snk_insert_new(spark, sf_dir):
    t = _narrow(spark, sf_dir)
    return L.insert_new(_target(t), _changes(t), KEY)


@query("snk_upsert", covers="SNK-7 JN-8", sql=_NARROW_SQL + f""",
src AS (SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY {', '.join(f"{c} NULLS FIRST" for c in SOURCE_ORDER)}) = 1)
SELECT * FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM src s WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)
UNION ALL SELECT * FROM src""")
def snk_upsert(spark, sf_dir):
    t = _narrow(spark, sf_dir)
    return L.upsert(_target(t), _changes(t), KEY, order=SOURCE_ORDER)


@query("snk_delete_insert", covers="SNK-11", sql=_NARROW_SQL + """
SELECT * FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM changes s WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)
UNION ALL SELECT * FROM changes""")
def snk_delete_insert(spark, sf_dir):
    t = _narrow(spark, sf_dir)
    return L.delete_insert(_target(t), _changes(t), KEY)


@query("snk_replace_interval", covers="SNK-10 FLT-2", sql=_NARROW_SQL + f"""
SELECT * FROM narrow WHERE (pickup_datetime >= TIMESTAMP '{INTERVAL[0]}' AND pickup_datetime < TIMESTAMP '{INTERVAL[1]}') IS NOT TRUE
UNION ALL
SELECT * FROM changes WHERE pickup_datetime >= TIMESTAMP '{INTERVAL[0]}' AND pickup_datetime < TIMESTAMP '{INTERVAL[1]}'
  AND payment_type <> 3""")
def snk_replace_interval(spark, sf_dir):
    t = _narrow(spark, sf_dir)
    # the re-run of the window drops 'no charge' trips: they must disappear from the table
    src = _changes(t).where(F.col("payment_type") != 3)
    return L.replace_interval(t, src, "pickup_datetime", *INTERVAL)


@query("snk_high_water_append", covers="SNK-8 FLT-10 AG-6", sql=_NARROW_SQL + """
SELECT * FROM target UNION ALL
SELECT * FROM narrow WHERE pickup_datetime > (SELECT max(pickup_datetime) FROM target)""")
def snk_high_water_append(spark, sf_dir):
    # the trips are joined three times (target, its maximum, source), never filtered to a few orders: no sorts
    t = _narrow(spark, sf_dir, orders_join="shuffle_hash")
    target = _target(t)
    return target.unionByName(L.high_water_rows(t, target, "pickup_datetime"))


@query("snk_append_new_columns", covers="SNK-9 SET-2", sql=D.with_sql(D.TRIPS_SQL) + f"""
SELECT l_orderkey, l_linenumber, pickup_datetime, fare_amount, CAST(NULL AS DECIMAL(18,4)) AS tip_amount
FROM trips WHERE pickup_datetime < TIMESTAMP '{TARGET_UNTIL}'
UNION ALL
SELECT l_orderkey, l_linenumber, pickup_datetime, fare_amount, tip_amount
FROM trips WHERE pickup_datetime >= TIMESTAMP '{TARGET_UNTIL}' OR pickup_datetime IS NULL""")
def snk_append_new_columns(spark, sf_dir):
    t = D.trips(spark, sf_dir, ["l_orderkey", "l_linenumber", "pickup_datetime", "fare_amount", "tip_amount"])
    cut = F.lit(TARGET_UNTIL).cast("timestamp_ntz")
    old = t.where(F.col("pickup_datetime") < cut).drop("tip_amount")
    new = t.where((F.col("pickup_datetime") >= cut) | F.col("pickup_datetime").isNull())
    return L.add_new_columns(old, new)


# --- the same loads through a table folder, read back ------------------------------------------------

def _folder(spark, partition_by=None) -> L.TableFolder:
    import uuid
    return L.TableFolder(spark, scratch_path(spark, "tables", f"load-{uuid.uuid4().hex[:12]}"), partition_by)


def _placed(t: DataFrame) -> DataFrame:
    return t.withColumn("pickup_month", F.date_format("pickup_datetime", "yyyy-MM"))


def _persisted(spark, sf_dir, strategy, changes=None, first=None, partition_by="pickup_month", **options) -> DataFrame:
    """Load the target, then the changes with ``strategy``, into a folder partitioned by month; read it."""
    t = _narrow(spark, sf_dir)
    table = _folder(spark, partition_by)
    L.materialize(spark, _placed(_target(t) if first is None else first(t)), "table", table)
    L.materialize(spark, _placed((changes or _changes)(t)), strategy, table, **options)
    return table.read().select(*NARROW)


@query("persisted_insert_new", covers="SNK-4 SNK-6 SNK-12 SNK-21 SNK-22", sql=_NARROW_SQL + """
SELECT * FROM target UNION ALL
SELECT c.* FROM changes c WHERE NOT EXISTS (
  SELECT 1 FROM target t WHERE t.l_orderkey = c.l_orderkey AND t.l_linenumber = c.l_linenumber)""")
def persisted_insert_new(spark, sf_dir):
    return _persisted(spark, sf_dir, "insert_new", key=KEY)


@query("persisted_merge", covers="SNK-4 SNK-7 SNK-21 SNK-22", sql=_NARROW_SQL + f""",
src AS (SELECT l_orderkey, l_linenumber, min(ROW({', '.join(f"{c} IS NOT NULL, {c}" for c in SOURCE_ORDER)})) AS f
        FROM changes GROUP BY l_orderkey, l_linenumber)
SELECT * FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM src s WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)
UNION ALL
SELECT l_orderkey, l_linenumber, f[4], f[6], f[2], f[8], f[10] FROM src""")
def persisted_merge(spark, sf_dir):
    # an order has one date, so a key never changes its month
    return _persisted(spark, sf_dir, "merge", key=KEY, order=SOURCE_ORDER, moves=False)


@query("persisted_delete_insert", covers="SNK-4 SNK-11 SNK-21 SNK-22", sql=_NARROW_SQL + """
SELECT * FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM changes s WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)
UNION ALL SELECT * FROM changes""")
def persisted_delete_insert(spark, sf_dir):
    return _persisted(spark, sf_dir, "delete_insert", key=KEY, moves=False)


@query("persisted_interval", covers="SNK-10 SNK-21 SNK-22", sql=_NARROW_SQL + f"""
SELECT * FROM narrow WHERE (pickup_datetime >= TIMESTAMP '{INTERVAL[0]}' AND pickup_datetime < TIMESTAMP '{INTERVAL[1]}') IS NOT TRUE
UNION ALL
SELECT * FROM changes WHERE pickup_datetime >= TIMESTAMP '{INTERVAL[0]}' AND pickup_datetime < TIMESTAMP '{INTERVAL[1]}'
  AND payment_type <> 3""")
def persisted_interval(spark, sf_dir):
    return _persisted(spark, sf_dir, "time_interval", first=lambda t: t, changes=lambda t: _changes(t).where("payment_type <> 3"),
                      incremental_key="pickup_datetime", window=INTERVAL, period="month")


@query("persisted_append", covers="SNK-5 SNK-22", sql=_NARROW_SQL + "SELECT * FROM target UNION ALL SELECT * FROM changes")
def persisted_append(spark, sf_dir):
    return _persisted(spark, sf_dir, "append", partition_by=None)


# --- named tables, replaced in one step ---------------------------------------------------------------

def _catalog_table(spark, name, partition_by=None) -> L.CatalogTable:
    import uuid
    return L.CatalogTable(spark, f"{name}_{uuid.uuid4().hex[:12]}", scratch_path(spark, "catalog"), partition_by)


@query("catalog_rebuild", covers="SNK-2 SNK-4 SRC-18", sql=_NARROW_SQL + "SELECT * FROM changes")
def catalog_rebuild(spark, sf_dir):
    """A named table is built, then replaced as a whole, and read by its name."""
    t = _narrow(spark, sf_dir)
    table = _catalog_table(spark, "trips")
    L.materialize(spark, _target(t), "table", table)
    L.materialize(spark, _changes(t), "table", table)
    return C.named(spark, table.name)


@query("catalog_merge", covers="SNK-4 SNK-7 SNK-9 SNK-11 SRC-18", sql=_NARROW_SQL + """
SELECT t.*, CAST(NULL AS INTEGER) AS delivery FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM changes s WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)
UNION ALL SELECT c.*, 2 AS delivery FROM changes c""")
def catalog_merge(spark, sf_dir):
    """A named table partitioned by month: a delivery with a new column replaces the rows of its keys."""
    t = _narrow(spark, sf_dir)
    table = _catalog_table(spark, "trips_by_month", "pickup_month")
    L.materialize(spark, _placed(_target(t)), "table", table)
    delivery = _placed(_changes(t)).withColumn("delivery", F.lit(2))
    L.materialize(spark, delivery, "merge", table, key=KEY, moves=False)
    return C.named(spark, table.name).select(*NARROW, "delivery")
