"""Binding of the driver tables onto the trip and event schemas.

The driver ships a TPC-H-like star schema plus an ``events`` stream table, not taxi files. Every
query in ``plans`` reads them through this module, so its work grows with the tables.

Trip binding (one trip per ``lineitem`` row)::

    vendor_id            CASE l_suppkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END
    service_type         CASE l_linestatus WHEN 'O' THEN 'Green' ELSE 'Yellow' END
    rate_code_id         CASE l_returnflag WHEN 'N' THEN 1 WHEN 'A' THEN 2 ELSE 3 END
    trip_type            CASE l_returnflag WHEN 'A' THEN 2 ELSE 1 END
    store_and_fwd_flag   CASE l_returnflag WHEN 'R' THEN 'Y' ELSE 'N' END
    pickup_datetime      o_orderdate                      (orders)
    dropoff_datetime     l_shipdate
    pickup_location_id   s_nationkey                      (supplier)
    dropoff_location_id  c_nationkey                      (orders -> customer)
    payment_type         int(first character of o_orderpriority)
    passenger_count      l_linenumber
    trip_distance        decimal(18,3) l_quantity
    fare_amount          decimal(18,3) l_extendedprice
    mta_tax              decimal(18,3) l_tax
    tip_amount           decimal(18,4) decimal(18,2) l_extendedprice * decimal(18,2) l_discount
    total_amount         decimal(18,3) o_totalprice
    zone / borough       n_name / r_name of the location's nation and region

Only the joins the requested columns need are planned: a count over pickup time and distance
never touches supplier or customer. All joins are left joins on unique keys, so a join that is left
out changes no row: a trip whose order, supplier or customer is missing has NULLs there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.functions.expr import MONEY

# Payment type codes and their descriptions (warehouse seed).
PAYMENT_TYPES = [
    (0, "Unknown"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]

# Payment type ids and names (interval pipeline lookup).
PAYMENT_NAMES = [
    (0, "flex_fare"),
    (1, "credit_card"),
    (2, "cash"),
    (3, "no_charge"),
    (4, "dispute"),
    (5, "unknown"),
    (6, "voided_trip"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a driver table. Scan splits follow ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- trip columns: expression and the source tables it needs ------------------------------------

def _trip_columns() -> dict[str, tuple[Column, set[str]]]:
    L, O, S, C = {"l"}, {"o"}, {"s"}, {"o", "c"}
    rf = F.col("l_returnflag")
    return {
        "vendor_id": (F.when(F.col("l_suppkey") % 3 == 0, 1).when(F.col("l_suppkey") % 3 == 1, 2)
                      .otherwise(4).cast("int"), L),
        "service_type": (F.when(F.col("l_linestatus") == "O", "Green").otherwise("Yellow"), L),
        "rate_code_id": (F.when(rf == "N", 1).when(rf == "A", 2).otherwise(3).cast("int"), L),
        "trip_type": (F.when(rf == "A", 2).otherwise(1).cast("int"), L),
        "store_and_fwd_flag": (F.when(rf == "R", "Y").otherwise("N"), L),
        "pickup_datetime": (F.col("o_orderdate"), O),
        "dropoff_datetime": (F.col("l_shipdate"), L),
        "pickup_location_id": (F.col("s_nationkey").cast("int"), S),
        "dropoff_location_id": (F.col("c_nationkey").cast("int"), C),
        "payment_type": (F.substring("o_orderpriority", 1, 1).cast("int"), O),
        "passenger_count": (F.col("l_linenumber").cast("int"), L),
        "trip_distance": (F.col("l_quantity").cast(MONEY), L),
        "fare_amount": (F.col("l_extendedprice").cast(MONEY), L),
        "extra": (F.lit(0).cast(MONEY), set()),
        "mta_tax": (F.col("l_tax").cast(MONEY), L),
        "tip_amount": ((F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(18,2)"))
                       .cast("decimal(18,4)"), L),
        "tolls_amount": (F.lit(0).cast(MONEY), set()),
        "improvement_surcharge": (F.lit(0.3).cast(MONEY), set()),
        "total_amount": (F.col("o_totalprice").cast(MONEY), O),
        # tie-break for dedup: the lineitem identity
        "l_orderkey": (F.col("l_orderkey"), L),
        "l_linenumber": (F.col("l_linenumber"), L),
        "l_partkey": (F.col("l_partkey"), L),
        "l_suppkey": (F.col("l_suppkey"), L),
    }


TRIP_COLUMNS = [
    "vendor_id", "service_type", "rate_code_id", "pickup_location_id", "dropoff_location_id",
    "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "passenger_count", "trip_distance",
    "trip_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "payment_type",
]


def trips(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None,
          where: Column | None = None, orders_join: str | None = None) -> DataFrame:
    """Trips with the requested columns, joining only the tables they need.

    A trip is a lineitem row: every join is a left join on the other table's unique key, so leaving
    out a join whose columns are not asked for gives exactly the same trips. ``where`` is applied on
    the result; Spark pushes a predicate on order columns into the orders scan (a predicate that no
    NULL satisfies also turns the left join into an inner one).

    Join plan: lineitem x orders is the fact-to-fact join (both sides shuffle on the order key, or
    AQE broadcasts the filtered orders side when it measures it small). orders x customer runs
    before it on the smaller orders side; supplier joins by supplier key. ``orders_join`` names a join
    hint for the orders: ``shuffle_hash`` keeps a task's share of the orders in memory and streams the
    lineitems past it, where a sort-merge join holds and sorts both (and grows with the lineitems).
    """
    spec = _trip_columns()
    columns = list(TRIP_COLUMNS if columns is None else columns)
    need: set[str] = set()
    for c in columns:
        need |= spec[c][1]
    df = table(spark, sf_dir, "lineitem")
    if "o" in need:
        orders = table(spark, sf_dir, "orders")
        if "c" in need:
            cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
            orders = orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
        if orders_join:
            orders = orders.hint(orders_join)
        df = df.join(orders, df.l_orderkey == orders.o_orderkey, "left")
    if "s" in need:
        sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        df = df.join(sup, df.l_suppkey == sup.s_suppkey, "left")
    df = df.select(*[spec[c][0].alias(c) for c in columns])
    return df.where(where) if where is not None else df


def trips_per_pickup_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pickup_location_id, trips``: counted per supplier key first (partial on the map side), so the
    supplier join sees one row per supplier instead of the whole fact table."""
    per_key = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (per_key.join(sup, per_key.l_suppkey == sup.s_suppkey, "left")
            .groupBy(F.col("s_nationkey").cast("int").alias("pickup_location_id"))
            .agg(F.sum("n").cast("bigint").alias("trips")))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup: location_id, borough, zone, service_zone (nation x region)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (n.join(r, n.n_regionkey == r.r_regionkey, "inner")
            .select(F.col("n_nationkey").cast("int").alias("location_id"),
                    F.col("r_name").alias("borough"),
                    F.col("n_name").alias("zone"),
                    F.lit("Boro Zone").alias("service_zone")))


def _literal(spark: SparkSession, rows: Sequence[tuple[int, str]], key: str, value: str) -> DataFrame:
    """A few fixed rows as a literal relation: its size is known to the planner, which broadcasts it."""
    values = ", ".join(f"({k}, '{v}')" for k, v in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({key}, {value})")


def payment_types(spark: SparkSession) -> DataFrame:
    return _literal(spark, PAYMENT_TYPES, "payment_type", "description")


def payment_names(spark: SparkSession) -> DataFrame:
    return _literal(spark, PAYMENT_NAMES, "payment_type_id", "payment_type_name")


# --- raw feeds (landing shape) -------------------------------------------------------------------

def _raw_columns(prefix: str, green: bool) -> list[Column]:
    cols = [
        F.col("vendor_id").cast("string").alias("VendorID"),
        F.col("pickup_datetime").alias(f"{prefix}_pickup_datetime"),
        F.col("dropoff_datetime").alias(f"{prefix}_dropoff_datetime"),
        F.col("store_and_fwd_flag"),
        F.col("rate_code_id").cast("string").alias("RatecodeID"),
        F.col("pickup_location_id").cast("string").alias("PULocationID"),
        F.col("dropoff_location_id").cast("string").alias("DOLocationID"),
        F.col("passenger_count").cast("bigint").alias("passenger_count"),
        F.col("trip_distance"),
        F.col("fare_amount"), F.col("extra"), F.col("mta_tax"), F.col("tip_amount"),
        F.col("tolls_amount"),
    ]
    if green:
        cols.append(F.lit(0).cast(MONEY).alias("ehail_fee"))
    cols += [F.col("improvement_surcharge"), F.col("total_amount"),
             F.col("payment_type").cast("int").alias("payment_type")]
    if green:
        cols.append(F.col("trip_type").cast("string").alias("trip_type"))
    return cols


def raw_taxi_feed(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """Landing shape of the green (``lpep_*``) or yellow (``tpep_*``) feed: raw names, raw types
    (ids as text, measures as numbers)."""
    prefix = "lpep" if service == "Green" else "tpep"
    t = trips(spark, sf_dir, TRIP_COLUMNS, where=F.col("service_type") == service)
    return t.select(*_raw_columns(prefix, service == "Green"))


def raw_taxi_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds from one binding, in the wider (green) landing shape, tagged with ``service_type``."""
    return trips(spark, sf_dir, TRIP_COLUMNS).select(*_raw_columns("lpep", True), "service_type")


def raw_fhv_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing shape of the for-hire feed, one row per order; base number NULL for status 'P',
    affiliated base number either a code such as 'B00042' or digits, SR flag NULL unless 'F'."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    base = F.concat(F.lit("B"), F.lpad((F.col("o_custkey") % 1000).cast("string"), 5, "0"))
    return (o.join(c, o.o_custkey == c.c_custkey, "left")
            .select(F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string")).otherwise(base)
                    .alias("dispatching_base_num"),
                    F.col("o_orderdate").alias("pickup_datetime"),
                    (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("dropOff_datetime"),
                    F.col("c_nationkey").cast("string").alias("PULocationID"),
                    (F.col("o_custkey") % 25).cast("string").alias("DOLocationID"),
                    F.when(F.col("o_orderstatus") == "F", F.lit("1")).alias("SR_FLAG"),
                    F.when(F.col("o_orderstatus") == "O", base)
                    .otherwise((F.col("o_custkey") % 100).cast("string")).alias("Affiliated_base_number")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# --- oracle SQL for the same binding (DuckDB dialect) ---------------------------------------------

TRIPS_SQL = """
trips AS (
  SELECT
    CASE WHEN l.l_suppkey % 3 = 0 THEN 1 WHEN l.l_suppkey % 3 = 1 THEN 2 ELSE 4 END AS vendor_id,
    CASE WHEN l.l_linestatus = 'O' THEN 'Green' ELSE 'Yellow' END AS service_type,
    CASE WHEN l.l_returnflag = 'N' THEN 1 WHEN l.l_returnflag = 'A' THEN 2 ELSE 3 END AS rate_code_id,
    CAST(s.s_nationkey AS INTEGER) AS pickup_location_id,
    CAST(c.c_nationkey AS INTEGER) AS dropoff_location_id,
    o.o_orderdate AS pickup_datetime,
    l.l_shipdate AS dropoff_datetime,
    CASE WHEN l.l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(l.l_linenumber AS INTEGER) AS passenger_count,
    CAST(l.l_quantity AS DECIMAL(18,3)) AS trip_distance,
    CASE WHEN l.l_returnflag = 'A' THEN 2 ELSE 1 END AS trip_type,
    CAST(l.l_extendedprice AS DECIMAL(18,3)) AS fare_amount,
    CAST(0 AS DECIMAL(18,3)) AS extra,
    CAST(l.l_tax AS DECIMAL(18,3)) AS mta_tax,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS tip_amount,
    CAST(0 AS DECIMAL(18,3)) AS tolls_amount,
    CAST(0.3 AS DECIMAL(18,3)) AS improvement_surcharge,
    CAST(o.o_totalprice AS DECIMAL(18,3)) AS total_amount,
    CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS payment_type,
    l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""

ZONES_SQL = """
zones AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS location_id, r.r_name AS borough, n.n_name AS zone,
         'Boro Zone' AS service_zone
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

PAYMENT_TYPES_SQL = "payment_types AS (SELECT * FROM (VALUES " + ", ".join(
    f"({k}, '{v}')" for k, v in PAYMENT_TYPES) + ") AS t(payment_type, description))"

PAYMENT_NAMES_SQL = "payment_names AS (SELECT * FROM (VALUES " + ", ".join(
    f"({k}, '{v}')" for k, v in PAYMENT_NAMES) + ") AS t(payment_type_id, payment_type_name))"

FHV_RAW_SQL = """
fhv_raw AS (
  SELECT
    CASE WHEN o.o_orderstatus = 'P' THEN NULL
         ELSE 'B' || lpad(CAST(o.o_custkey % 1000 AS VARCHAR), 5, '0') END AS dispatching_base_num,
    o.o_orderdate AS pickup_datetime,
    o.o_orderdate + INTERVAL 1 DAY AS dropOff_datetime,
    CAST(c.c_nationkey AS VARCHAR) AS PULocationID,
    CAST(o.o_custkey % 25 AS VARCHAR) AS DOLocationID,
    CASE WHEN o.o_orderstatus = 'F' THEN '1' END AS SR_FLAG,
    CASE WHEN o.o_orderstatus = 'O' THEN 'B' || lpad(CAST(o.o_custkey % 1000 AS VARCHAR), 5, '0')
         ELSE CAST(o.o_custkey % 100 AS VARCHAR) END AS Affiliated_base_number
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
