"""Warehouse model build (Q-M4-*): staging -> union -> dedup/enrich -> star schema -> marts.

Spark plan shape of the fact build, per stage:
  scan lineitem/orders/supplier/customer (pruned columns) -> fact-to-fact join on the order key, once
  for both feeds -> rename/cast by feed (one projection) -> ROW_NUMBER()=1 per trip key
  (WindowGroupLimit, partial before the shuffle) -> surrogate key + payment lookup on the survivors
  -> two zone lookups (lookups are small files, which Spark broadcasts) -> marts (partial aggregation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.functions import expr as X
from meterstar.operators import dedup, star
from meterstar.operators.staging import FHV_FIELDS, UNIONED_COLUMNS, standardize, taxi_fields
from meterstar.plans.registry import query
from meterstar.sources import driver_tables as D

DEDUP_KEY = ["vendor_id", "pickup_datetime", "pickup_location_id", "service_type"]
# The reference orders by dropoff time only; the remaining columns make the order total, so the
# surviving row is the same on every run and engine.
DEDUP_ORDER = ["dropoff_datetime", "dropoff_location_id", "rate_code_id", "store_and_fwd_flag",
               "passenger_count", "trip_distance", "trip_type", "fare_amount", "extra", "mta_tax",
               "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount", "payment_type"]
# Measures, mart sums and columns of the fact and mart tables (their contract).
MONEY_MEASURES = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
                  "improvement_surcharge", "total_amount"]
MART_SUMS = {
    "revenue_monthly_fare": "fare_amount",
    "revenue_monthly_extra": "extra",
    "revenue_monthly_mta_tax": "mta_tax",
    "revenue_monthly_tip_amount": "tip_amount",
    "revenue_monthly_tolls_amount": "tolls_amount",
    "revenue_monthly_ehail_fee": "ehail_fee",
    "revenue_monthly_improvement_surcharge": "improvement_surcharge",
    "revenue_monthly_total_amount": "total_amount",
}
FCT_COLUMNS = [
    "trip_id", "vendor_id", "service_type", "rate_code_id",
    "pickup_location_id", "pickup_borough", "pickup_zone",
    "dropoff_location_id", "dropoff_borough", "dropoff_zone",
    "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag",
    "passenger_count", "trip_distance", "trip_type", "trip_duration_minutes",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
    "improvement_surcharge", "total_amount", "payment_type", "payment_type_description",
]
# Enforced contract of the fact table (DQ-12): names and types, column order free.
FCT_CONTRACT = ", ".join([
    "trip_id string", "vendor_id int", "service_type string", "rate_code_id int",
    "pickup_location_id int", "pickup_borough string", "pickup_zone string",
    "dropoff_location_id int", "dropoff_borough string", "dropoff_zone string",
    "pickup_datetime timestamp_ntz", "dropoff_datetime timestamp_ntz", "store_and_fwd_flag string",
    "passenger_count int", "trip_distance decimal(18,3)", "trip_type int", "trip_duration_minutes bigint",
    *[f"{m} decimal(18,3)" for m in MONEY_MEASURES],
    "payment_type int", "payment_type_description string",
])
TOP_ZONE_YEAR = 1997
TRIPS_MONTH = (1996, 10)


# --- model functions ----------------------------------------------------------------------------

def stg_green(spark: SparkSession, sf_dir: str, sample_window=None) -> DataFrame:
    raw = D.raw_taxi_feed(spark, sf_dir, "Green")
    return standardize(raw, taxi_fields("lpep", green=True), not_null=["VendorID"], sample_window=sample_window)


def stg_yellow(spark: SparkSession, sf_dir: str, sample_window=None) -> DataFrame:
    raw = D.raw_taxi_feed(spark, sf_dir, "Yellow")
    return standardize(raw, taxi_fields("tpep", green=False), not_null=["VendorID"], sample_window=sample_window)


def stg_fhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize(D.raw_fhv_feed(spark, sf_dir), FHV_FIELDS, not_null=["dispatching_base_num"])


def trips_unioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds under one another, from one binding of the trips.

    The feeds differ by projection only (names, safe or strict casts, the two columns that yellow does
    not have), so the tables are joined once, each row is tagged with its feed, and the feed picks the
    projection. Equal to the union of ``stg_green`` and ``stg_yellow``, at half the joins.
    """
    green = F.col("service_type") == "Green"
    raw = D.raw_taxi_feeds(spark, sf_dir)
    safe = {f.target: f for f in taxi_fields("lpep", green=True)}
    strict = {f.target: f for f in taxi_fields("lpep", green=False)}
    filler = {"trip_type": F.lit(1).cast("int"), "ehail_fee": F.lit(0).cast(X.MONEY)}
    cols = []
    for name in UNIONED_COLUMNS[:-1]:
        g, y = safe[name], strict.get(name)
        ours = X.safe_cast(g.source, g.type) if g.safe else F.col(g.source).cast(g.type)
        theirs = filler[name] if y is None else F.col(y.source).cast(y.type)
        cols.append((ours if y is not None and not g.safe else F.when(green, ours).otherwise(theirs)).alias(name))
    return raw.where(F.col("VendorID").isNotNull()).select(*cols, "service_type")


def int_trips(spark: SparkSession, sf_dir: str, unioned: DataFrame | None = None) -> DataFrame:
    """Deduplicated, enriched trips. The survivor depends only on the dedup key and order, so the
    surrogate key (a function of the dedup key) and the payment lookup run after the dedup, on the
    surviving rows only."""
    u = unioned if unioned is not None else trips_unioned(spark, sf_dir)
    u = u.withColumn("payment_type", F.coalesce(F.col("payment_type"), F.lit(0)))
    u = dedup.keep_first(u, DEDUP_KEY, DEDUP_ORDER)
    u = u.withColumn("trip_id", X.surrogate_key(DEDUP_KEY))
    u = star.enrich(u, D.payment_types(spark), "payment_type", "payment_type",
                    {"description": "payment_type_description"}, how="left")
    u = u.withColumn("payment_type_description", F.coalesce("payment_type_description", F.lit("Unknown")))
    return u.select("trip_id", *[c for c in UNIONED_COLUMNS if c != "payment_type"],
                    "payment_type", "payment_type_description")


def dim_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.zones(spark, sf_dir).select("location_id", "borough", "zone", "service_zone")


def fct_trips(spark: SparkSession, sf_dir: str, trips: DataFrame | None = None) -> DataFrame:
    t = trips if trips is not None else int_trips(spark, sf_dir)
    t = star.role_playing(t, dim_zones(spark, sf_dir), "location_id",
                          {"pickup": "pickup_location_id", "dropoff": "dropoff_location_id"},
                          ["borough", "zone"], how="left")
    t = t.withColumn("trip_duration_minutes", X.minute_boundaries("pickup_datetime", "dropoff_datetime"))
    return t.select(*FCT_COLUMNS)


def dim_vendors(trips: DataFrame) -> DataFrame:
    """Distinct vendors with their names.

    Equal when given the fact table or the unioned feeds: dedup keeps one row per key and the key
    contains ``vendor_id``, and the fact's zone joins are left joins, so no vendor is lost in
    between. Building from the union skips the dedup shuffle and the zone joins.
    """
    return trips.select("vendor_id").distinct().withColumn("vendor_name", X.vendor_name("vendor_id"))


def monthly_zone_revenue(fct: DataFrame) -> DataFrame:
    """Group by the full expressions (not by output aliases that shadow input columns)."""
    return fct.groupBy(
        F.coalesce("pickup_zone", F.lit("Unknown Zone")).alias("pickup_zone"),
        X.month_start("pickup_datetime").alias("revenue_month"),
        F.col("service_type"),
    ).agg(
        *[F.sum(src).cast("decimal(38,3)").alias(dst) for dst, src in MART_SUMS.items()],
        F.count("trip_id").alias("total_monthly_trips"),
        X.mean("passenger_count").alias("avg_monthly_passenger_count"),
        X.mean("trip_distance").alias("avg_monthly_trip_distance"),
    )


def top_zone_for_year(mart: DataFrame, service: str, year: int) -> DataFrame:
    g = (mart.where((F.col("service_type") == service) & (F.year("revenue_month") == year))
         .groupBy("pickup_zone").agg(F.sum("revenue_monthly_total_amount").alias("total_revenue")))
    return dedup.top_n(g, [F.col("total_revenue").desc(), F.col("pickup_zone").asc()], 1)


def trips_in_month(mart: DataFrame, service: str, year: int, month: int) -> DataFrame:
    return (mart.where((F.col("service_type") == service) & (F.year("revenue_month") == year)
                       & (F.month("revenue_month") == month))
            .agg(F.sum("total_monthly_trips").alias("total_trips")))


# --- oracle SQL ----------------------------------------------------------------------------------

def _raw_sql(service: str, prefix: str) -> str:
    green = service == "Green"
    cols = [
        "CAST(vendor_id AS VARCHAR) AS VendorID",
        f"pickup_datetime AS {prefix}_pickup_datetime",
        f"dropoff_datetime AS {prefix}_dropoff_datetime",
        "store_and_fwd_flag",
        "CAST(rate_code_id AS VARCHAR) AS RatecodeID",
        "CAST(pickup_location_id AS VARCHAR) AS PULocationID",
        "CAST(dropoff_location_id AS VARCHAR) AS DOLocationID",
        "CAST(passenger_count AS BIGINT) AS passenger_count",
        "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    ]
    if green:
        cols.append("CAST(0 AS DECIMAL(18,3)) AS ehail_fee")
    cols += ["improvement_surcharge", "total_amount", "payment_type"]
    if green:
        cols.append("CAST(trip_type AS VARCHAR) AS trip_type")
    return f"{service.lower()}_raw AS (SELECT {', '.join(cols)} FROM trips WHERE service_type = '{service}')"


def _stg_sql(service: str, prefix: str) -> str:
    green = service == "Green"
    safe = "TRY_CAST" if green else "CAST"
    cols = [
        "CAST(VendorID AS INTEGER) AS vendor_id",
        f"{safe}(RatecodeID AS INTEGER) AS rate_code_id",
        "CAST(PULocationID AS INTEGER) AS pickup_location_id",
        "CAST(DOLocationID AS INTEGER) AS dropoff_location_id",
        f"CAST({prefix}_pickup_datetime AS TIMESTAMP) AS pickup_datetime",
        f"CAST({prefix}_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime",
        "CAST(store_and_fwd_flag AS VARCHAR) AS store_and_fwd_flag",
        "CAST(passenger_count AS INTEGER) AS passenger_count",
        "CAST(trip_distance AS DECIMAL(18,3)) AS trip_distance",
    ]
    if green:
        cols.append("TRY_CAST(trip_type AS INTEGER) AS trip_type")
    money = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount"] + (["ehail_fee"] if green else []) + [
        "improvement_surcharge", "total_amount"]
    cols += [f"CAST({m} AS DECIMAL(18,3)) AS {m}" for m in money]
    cols.append(f"{safe}(payment_type AS INTEGER) AS payment_type")
    return (f"stg_{service.lower()} AS (SELECT {', '.join(cols)} FROM {service.lower()}_raw "
            f"WHERE VendorID IS NOT NULL)")


_UNION_SQL = """
unioned AS (
  SELECT vendor_id, rate_code_id, pickup_location_id, dropoff_location_id, pickup_datetime, dropoff_datetime,
         store_and_fwd_flag, passenger_count, trip_distance, trip_type, fare_amount, extra, mta_tax, tip_amount,
         tolls_amount, ehail_fee, improvement_surcharge, total_amount, payment_type, 'Green' AS service_type
  FROM stg_green
  UNION ALL
  SELECT vendor_id, rate_code_id, pickup_location_id, dropoff_location_id, pickup_datetime, dropoff_datetime,
         store_and_fwd_flag, passenger_count, trip_distance, CAST(1 AS INTEGER) AS trip_type, fare_amount, extra,
         mta_tax, tip_amount, tolls_amount, CAST(0 AS DECIMAL(18,3)) AS ehail_fee, improvement_surcharge,
         total_amount, payment_type, 'Yellow' AS service_type
  FROM stg_yellow
)"""

# Written out for the oracle on its own: key mark, tie-break columns after the drop-off time, mart sums.
_TIE_SQL = """dropoff_datetime dropoff_location_id rate_code_id store_and_fwd_flag passenger_count trip_distance
trip_type fare_amount extra mta_tax tip_amount tolls_amount ehail_fee improvement_surcharge total_amount paid"""
_TIES = _TIE_SQL.split()
# The survivor of a key is the smallest row of (is there a value, value) pairs: NULLs come first.
_INT_SQL = f"""
best AS (
  SELECT vendor_id, pickup_datetime, pickup_location_id, service_type,
         min(ROW({", ".join(f"{c} IS NOT NULL, {c}" for c in _TIES)})) AS b
  FROM (SELECT *, coalesce(payment_type, 0) AS paid FROM unioned)
  GROUP BY ALL),
int_trips AS (
  SELECT md5(coalesce(vendor_id::VARCHAR, '_dbt_utils_surrogate_key_null_') || '-' ||
             coalesce(pickup_datetime::VARCHAR, '_dbt_utils_surrogate_key_null_') || '-' ||
             coalesce(pickup_location_id::VARCHAR, '_dbt_utils_surrogate_key_null_') || '-' ||
             coalesce(service_type, '_dbt_utils_surrogate_key_null_')) AS trip_id,
         vendor_id, pickup_datetime, pickup_location_id, service_type,
         {", ".join(f"b[{2 * i + 2}] AS {c if c != 'paid' else 'payment_type'}" for i, c in enumerate(_TIES))},
         coalesce(description, 'Unknown') AS payment_type_description
  FROM best LEFT JOIN payment_types pt ON b[{2 * len(_TIES)}] = pt.payment_type
)"""

_FCT_SQL = """
fct AS (
  SELECT t.trip_id, t.vendor_id, t.service_type, t.rate_code_id,
         t.pickup_location_id, pz.borough AS pickup_borough, pz.zone AS pickup_zone,
         t.dropoff_location_id, dz.borough AS dropoff_borough, dz.zone AS dropoff_zone,
         t.pickup_datetime, t.dropoff_datetime, t.store_and_fwd_flag,
         t.passenger_count, t.trip_distance, t.trip_type,
         date_diff('minute', t.pickup_datetime, t.dropoff_datetime) AS trip_duration_minutes,
         t.fare_amount, t.extra, t.mta_tax, t.tip_amount, t.tolls_amount, t.ehail_fee,
         t.improvement_surcharge, t.total_amount, t.payment_type, t.payment_type_description
  FROM int_trips t
  LEFT JOIN zones pz ON t.pickup_location_id = pz.location_id
  LEFT JOIN zones dz ON t.dropoff_location_id = dz.location_id
)"""

_MART_SQL = """mart AS (
  SELECT coalesce(pickup_zone, 'Unknown Zone') AS pickup_zone, CAST(date_trunc('month', pickup_datetime) AS DATE) AS revenue_month,
         service_type,
         CAST(sum(fare_amount) AS DECIMAL(38,3)) AS revenue_monthly_fare,
         CAST(sum(extra) AS DECIMAL(38,3)) AS revenue_monthly_extra,
         CAST(sum(mta_tax) AS DECIMAL(38,3)) AS revenue_monthly_mta_tax,
         CAST(sum(tip_amount) AS DECIMAL(38,3)) AS revenue_monthly_tip_amount,
         CAST(sum(tolls_amount) AS DECIMAL(38,3)) AS revenue_monthly_tolls_amount,
         CAST(sum(ehail_fee) AS DECIMAL(38,3)) AS revenue_monthly_ehail_fee,
         CAST(sum(improvement_surcharge) AS DECIMAL(38,3)) AS revenue_monthly_improvement_surcharge,
         CAST(sum(total_amount) AS DECIMAL(38,3)) AS revenue_monthly_total_amount,
         count(trip_id) AS total_monthly_trips,
         CAST(sum(passenger_count) AS DOUBLE) / count(passenger_count) AS avg_monthly_passenger_count,
         CAST(sum(trip_distance) AS DOUBLE) / count(trip_distance) AS avg_monthly_trip_distance
  FROM fct GROUP BY 1, 2, 3)"""

STG_GREEN_SQL = D.with_sql(D.TRIPS_SQL, _raw_sql("Green", "lpep"), _stg_sql("Green", "lpep"))
UNION_SQL = D.with_sql(D.TRIPS_SQL, _raw_sql("Green", "lpep"), _stg_sql("Green", "lpep"),
                       _raw_sql("Yellow", "tpep"), _stg_sql("Yellow", "tpep"), _UNION_SQL)
INT_SQL = D.with_sql(D.TRIPS_SQL, D.ZONES_SQL, D.PAYMENT_TYPES_SQL, _raw_sql("Green", "lpep"),
                     _stg_sql("Green", "lpep"), _raw_sql("Yellow", "tpep"), _stg_sql("Yellow", "tpep"),
                     _UNION_SQL, _INT_SQL)
FCT_SQL = INT_SQL.rstrip() + ",\n" + _FCT_SQL.strip() + "\n"
MART_SQL = FCT_SQL.rstrip() + ",\n" + _MART_SQL + "\n"

_FHV_SQL = D.with_sql(D.FHV_RAW_SQL, """
stg_fhv AS (
  SELECT CAST(PULocationID AS INTEGER) AS pickup_location_id, CAST(DOLocationID AS INTEGER) AS dropoff_location_id,
         CAST(pickup_datetime AS TIMESTAMP) AS pickup_datetime, CAST(dropOff_datetime AS TIMESTAMP) AS dropoff_datetime,
         CAST(dispatching_base_num AS VARCHAR) AS dispatching_base_num,
         TRY_CAST(Affiliated_base_number AS INTEGER) AS affiliated_base_number,
         TRY_CAST(SR_FLAG AS INTEGER) AS sr_flag
  FROM fhv_raw WHERE dispatching_base_num IS NOT NULL)""")


# --- registered queries ---------------------------------------------------------------------------

@query("m4_stg_green", covers="Q-M4-stg-green PRJ-1 FN-1 FN-2 FLT-1", sql=STG_GREEN_SQL + "SELECT * FROM stg_green")
def q_stg_green(spark, sf_dir):
    return stg_green(spark, sf_dir)


STG_YELLOW_SQL = D.with_sql(D.TRIPS_SQL, _raw_sql("Yellow", "tpep"), _stg_sql("Yellow", "tpep"))


@query("m4_stg_yellow", covers="Q-M4-stg-yellow PRJ-1 FN-1 FLT-1", sql=STG_YELLOW_SQL + "SELECT * FROM stg_yellow")
def q_stg_yellow(spark, sf_dir):
    return stg_yellow(spark, sf_dir)


@query("m4_stg_fhv", covers="Q-M4-stg-fhv PRJ-1 FN-2 FLT-1", sql=_FHV_SQL + "SELECT * FROM stg_fhv")
def q_stg_fhv(spark, sf_dir):
    return stg_fhv(spark, sf_dir)


@query("m4_trips_unioned", covers="Q-M4-union PRJ-2 PRJ-4 SET-1", sql=UNION_SQL + "SELECT * FROM unioned")
def q_trips_unioned(spark, sf_dir):
    return trips_unioned(spark, sf_dir)


@query("m4_int_trips", covers="Q-M4-int FN-7 JN-2 WN-1 FLT-11", sql=INT_SQL + "SELECT * FROM int_trips")
def q_int_trips(spark, sf_dir):
    return int_trips(spark, sf_dir)


@query("m4_fct_trips", covers="Q-M4-fct JN-3 FN-9", sql=FCT_SQL + "SELECT * FROM fct")
def q_fct_trips(spark, sf_dir):
    return fct_trips(spark, sf_dir)


@query("m4_dim_zones", covers="Q-M4-dimz", sql=D.with_sql(D.ZONES_SQL) + "SELECT * FROM zones")
def q_dim_zones(spark, sf_dir):
    return dim_zones(spark, sf_dir)


@query("m4_dim_vendors", covers="Q-M4-dimv AG-7 FN-8", sql=FCT_SQL + """
SELECT DISTINCT vendor_id, CASE vendor_id WHEN 1 THEN 'Creative Mobile Technologies'
  WHEN 2 THEN 'VeriFone Inc.' WHEN 4 THEN 'Unknown/Other' END AS vendor_name FROM fct""")
def q_dim_vendors(spark, sf_dir):
    return dim_vendors(trips_unioned(spark, sf_dir))


@query("m4_monthly_zone_revenue", covers="Q-M4-mart AG-2 AG-4 AG-5 AG-8 FN-3 FN-10", sql=MART_SQL + "SELECT * FROM mart")
def q_monthly_zone_revenue(spark, sf_dir):
    return monthly_zone_revenue(fct_trips(spark, sf_dir))


@query("m4_mart_row_count", covers="Q-M4-3 AG-1", sql=MART_SQL + "SELECT count(*) AS row_count FROM mart")
def q_mart_row_count(spark, sf_dir):
    return monthly_zone_revenue(fct_trips(spark, sf_dir)).agg(F.count(F.lit(1)).alias("row_count"))


@query("m4_top_green_zone_for_year", covers="Q-M4-4 FLT-8 FN-11 AG-4 WN-2", sql=MART_SQL + f"""
SELECT pickup_zone, sum(revenue_monthly_total_amount) AS total_revenue FROM mart
WHERE service_type = 'Green' AND extract(year FROM revenue_month) = {TOP_ZONE_YEAR}
GROUP BY pickup_zone ORDER BY total_revenue DESC, pickup_zone ASC LIMIT 1""")
def q_top_green_zone_for_year(spark, sf_dir):
    return top_zone_for_year(monthly_zone_revenue(fct_trips(spark, sf_dir)), "Green", TOP_ZONE_YEAR)


@query("m4_green_trips_in_month", covers="Q-M4-5 FLT-8 FLT-13 AG-4", sql=MART_SQL + f"""
SELECT CAST(sum(total_monthly_trips) AS BIGINT) AS total_trips FROM mart
WHERE service_type = 'Green' AND extract(year FROM revenue_month) = {TRIPS_MONTH[0]}
  AND extract(month FROM revenue_month) = {TRIPS_MONTH[1]}""")
def q_green_trips_in_month(spark, sf_dir):
    return trips_in_month(monthly_zone_revenue(fct_trips(spark, sf_dir)), "Green", *TRIPS_MONTH)


@query("m4_fhv_rows_with_base", covers="Q-M4-6 FLT-1 AG-1", sql=_FHV_SQL + """
SELECT count(*) AS fhv_rows FROM stg_fhv WHERE dispatching_base_num IS NOT NULL""")
def q_fhv_rows_with_base(spark, sf_dir):
    return stg_fhv(spark, sf_dir).where(F.col("dispatching_base_num").isNotNull()).agg(
        F.count(F.lit(1)).alias("fhv_rows"))


# --- persisted, incremental fact load (SNK-7/8/9 as the fact model uses them) ----------------------

def load_fct(spark: SparkSession, sf_dir: str, table, until: str | None = None, full_refresh: bool = False,
             lookback: str | None = None) -> None:
    """Build or extend the persisted fact table (a ``TableFolder``, best partitioned by ``pickup_date`` or ``pickup_month``).

    The contract (DQ-12) and the row-level model tests (DQ-14) are enforced before anything is
    written: a violation raises and the table stays as it was. First run (or ``full_refresh``): the
    whole fact table. Later runs: only trips picked up after the table's latest pickup (strict ``>``,
    optionally widened by ``lookback``), merged on ``trip_id``; new columns are appended, none dropped.
    ``until`` limits the source to pickups before a time (the data available at that run).
    """
    from meterstar.operators import quality as Q
    from meterstar.operators.load import high_water_rows, materialize
    from meterstar.session import drop_materialized, materialized

    fct = fct_trips(spark, sf_dir)
    if until:
        fct = fct.where(F.col("pickup_datetime") < F.lit(until).cast("timestamp_ntz"))
    target = None if full_refresh else table.read()
    if target is not None:
        newest = table.newest() if table.partition_by in ("pickup_date", "pickup_month") else target
        fct = high_water_rows(fct, newest, "pickup_datetime", lookback)
    problems = Q.contract_violations(fct, FCT_CONTRACT)
    if problems:
        raise Q.QualityError("; ".join(problems))
    fct = materialized(fct, "fct_delivery")
    Q.enforce(Q.run_checks(fct, [Q.not_null("trip_id"), Q.unique("trip_id"), Q.not_null("vendor_id"),
                                 Q.accepted_values("service_type", ["Green", "Yellow"]), Q.non_negative("trip_distance")]))
    # a partitioned table takes its folder column from the pickup time: its day or its month
    folder = {"pickup_date": F.to_date("pickup_datetime"), "pickup_month": F.date_format("pickup_datetime", "yyyy-MM")}
    placed = fct.withColumns({c: e for c, e in folder.items() if c == table.partition_by})
    # a trip id contains the pickup time, so a trip never changes its folder
    materialize(spark, placed, "merge", table, key=["trip_id"], full_refresh=full_refresh, moves=table.partition_by not in folder)
    drop_materialized(fct)
