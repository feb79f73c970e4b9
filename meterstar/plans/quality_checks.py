"""Data-quality runs over the built models (DQ-1..13), as registered queries with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterstar.operators import quality as Q
from meterstar.plans import interval, warehouse
from meterstar.plans.registry import query
from meterstar.session import materialized
from meterstar.sources import driver_tables as D

ACCEPTED_PAYMENT = [1, 2, 3, 4, 5]
FRESHNESS_RUN_AT = "2001-08-03 12:00:00"


def fct_checks(spark, sf_dir, fct):
    zones = warehouse.dim_zones(spark, sf_dir)
    return [
        Q.not_null("trip_id"),
        Q.unique("trip_id"),
        Q.accepted_values("service_type", ["Green", "Yellow"]),
        Q.accepted_values("payment_type", ACCEPTED_PAYMENT),
        Q.relationships("pickup_location_id", zones, "location_id"),
        Q.relationships("dropoff_location_id", zones, "location_id"),
        Q.non_negative("trip_distance"),
        Q.not_null("pickup_datetime"),
        Q.not_null("vendor_id"),
        Q.not_null("total_amount"),
    ]


def _checks_sql(table: str, rows: list[tuple[str, str, str]]) -> str:
    body = "\nUNION ALL\n".join(f"SELECT '{k}' AS \"check\", '{c}' AS \"column\", CAST(({q}) AS BIGINT) AS failing_rows"
                                for k, c, q in rows)
    return f"SELECT *, failing_rows = 0 AS passed FROM (\n{body}\n)"


_FCT_ROWS = [
    ("not_null", "trip_id", "SELECT count_if(trip_id IS NULL) FROM fct"),
    ("accepted_values", "service_type", "SELECT count_if(service_type NOT IN ('Green', 'Yellow')) FROM fct"),
    ("accepted_values", "payment_type",
     f"SELECT count_if(payment_type NOT IN ({', '.join(map(str, ACCEPTED_PAYMENT))})) FROM fct"),
    ("non_negative", "trip_distance", "SELECT count_if(trip_distance < 0) FROM fct"),
    ("not_null", "pickup_datetime", "SELECT count_if(pickup_datetime IS NULL) FROM fct"),
    ("not_null", "vendor_id", "SELECT count_if(vendor_id IS NULL) FROM fct"),
    ("not_null", "total_amount", "SELECT count_if(total_amount IS NULL) FROM fct"),
    ("unique", "trip_id", "SELECT count(*) FROM (SELECT trip_id FROM fct WHERE trip_id IS NOT NULL "
                          "GROUP BY trip_id HAVING count(*) > 1)"),
    ("relationships", "pickup_location_id", "SELECT count(*) FROM fct f WHERE f.pickup_location_id IS NOT NULL "
     "AND NOT EXISTS (SELECT 1 FROM zones z WHERE z.location_id = f.pickup_location_id)"),
    ("relationships", "dropoff_location_id", "SELECT count(*) FROM fct f WHERE f.dropoff_location_id IS NOT NULL "
     "AND NOT EXISTS (SELECT 1 FROM zones z WHERE z.location_id = f.dropoff_location_id)"),
]


@query("dq_fct_trips", covers="DQ-1 DQ-2 DQ-3 DQ-4 DQ-8 JN-7", sql=warehouse.FCT_SQL + _checks_sql("fct", _FCT_ROWS))
def dq_fct_trips(spark, sf_dir):
    # the fact table is built once (as the warehouse materialises it), then every check scans it
    fct = materialized(warehouse.fct_trips(spark, sf_dir), "fct_trips")
    return Q.run_checks(fct, fct_checks(spark, sf_dir, fct))


MART_NOT_NULL = ["pickup_zone", "revenue_month", "service_type", "revenue_monthly_total_amount",
                 "total_monthly_trips"]
_MART_ROWS = [
    ("expression_is_true", "total_monthly_trips > 0", "SELECT count_if(NOT (total_monthly_trips > 0)) FROM mart"),
    *[("not_null", c, f"SELECT count_if({c} IS NULL) FROM mart") for c in MART_NOT_NULL],
    ("accepted_values", "service_type", "SELECT count_if(service_type NOT IN ('Green', 'Yellow')) FROM mart"),
    ("unique_combination", "pickup_zone,revenue_month,service_type",
     "SELECT count(*) FROM (SELECT 1 FROM mart GROUP BY pickup_zone, revenue_month, service_type HAVING count(*) > 1)"),
]


@query("dq_monthly_zone_revenue", covers="DQ-5 DQ-6 DQ-1", sql=warehouse.MART_SQL + _checks_sql("mart", _MART_ROWS))
def dq_monthly_zone_revenue(spark, sf_dir):
    mart = warehouse.monthly_zone_revenue(warehouse.fct_trips(spark, sf_dir))
    return Q.run_checks(mart, [
        Q.expression_is_true("total_monthly_trips > 0"),
        *[Q.not_null(c) for c in MART_NOT_NULL],
        Q.accepted_values("service_type", ["Green", "Yellow"]),
        Q.unique_combination(["pickup_zone", "revenue_month", "service_type"]),
    ])


_STG_ROWS = [
    ("not_null", "pickup_datetime", "SELECT count_if(pickup_datetime IS NULL) FROM staging"),
    ("non_negative", "fare_amount", "SELECT count_if(fare_amount < 0) FROM staging"),
    ("row_count_greater_than_zero", "*",
     "SELECT CASE WHEN (SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM staging) = 1 THEN 0 ELSE 1 END"),
]


@query("dq_interval_staging", covers="DQ-1 DQ-8 DQ-10 DQ-11 AG-10",
       sql=interval._staging_sql(interval.FULL_RUN) + _checks_sql("staging", _STG_ROWS))
def dq_interval_staging(spark, sf_dir):
    stg = interval.staging_trips(spark, sf_dir)
    return Q.run_checks(stg, [
        Q.not_null("pickup_datetime"),
        Q.non_negative("fare_amount"),
        Q.scalar(Q.flag_any(stg, F.lit(True)), 1, "row_count_greater_than_zero"),
    ])


REPORT_KEY = ["trip_date", "taxi_type", "payment_type"]
_REP_ROWS = [
    *[("not_null", c, f"SELECT count_if({c} IS NULL) FROM report") for c in REPORT_KEY],
    ("non_negative", "trip_count", "SELECT count_if(trip_count < 0) FROM report"),
    ("positive", "trip_count", "SELECT count_if(trip_count <= 0) FROM report"),
    ("unique_combination", "trip_date,taxi_type,payment_type",
     "SELECT count(*) FROM (SELECT 1 FROM report GROUP BY trip_date, taxi_type, payment_type HAVING count(*) > 1)"),
]


@query("dq_trips_report", covers="DQ-5 DQ-8 DQ-9 DQ-11",
       sql=interval._staging_sql(interval.FULL_RUN) + f", report AS ({interval._report_sql('staging', interval.FULL_RUN)})\n"
       + _checks_sql("report", _REP_ROWS))
def dq_trips_report(spark, sf_dir):
    rep = interval.trips_report(interval.staging_trips(spark, sf_dir))
    return Q.run_checks(rep, [
        *[Q.not_null(c) for c in REPORT_KEY],
        Q.non_negative("trip_count"),
        Q.positive("trip_count"),
        Q.unique_combination(["trip_date", "taxi_type", "payment_type"]),
    ])


@query("dq_source_freshness", covers="DQ-13", sql=D.with_sql(D.TRIPS_SQL) + f"""
SELECT 'trips' AS source, max(pickup_datetime) AS max_loaded_at,
       (epoch(TIMESTAMP '{FRESHNESS_RUN_AT}') - epoch(max(pickup_datetime))) / 3600.0 AS age_hours,
       CASE WHEN (epoch(TIMESTAMP '{FRESHNESS_RUN_AT}') - epoch(max(pickup_datetime))) / 3600.0 > 48 THEN 'error'
            WHEN (epoch(TIMESTAMP '{FRESHNESS_RUN_AT}') - epoch(max(pickup_datetime))) / 3600.0 > 24 THEN 'warn'
            ELSE 'pass' END AS status
FROM trips""")
def dq_source_freshness(spark, sf_dir):
    t = D.trips(spark, sf_dir, ["pickup_datetime"])
    return Q.freshness(t, "pickup_datetime", FRESHNESS_RUN_AT, source="trips")


# --- model tests of the warehouse layers (staging, intermediate, dimensions, seed, one-row reports) --

def _models_sql(parts: list[tuple[str, list[tuple[str, str, str]]]]) -> str:
    body = "\nUNION ALL\n".join(
        f"SELECT '{m}' AS model, '{k}' AS \"check\", '{c}' AS \"column\", CAST(({q}) AS BIGINT) AS failing_rows"
        for m, rows in parts for k, c, q in rows)
    return f"SELECT *, failing_rows = 0 AS passed FROM (\n{body}\n)"


def _nn(t, c):
    return ("not_null", c, f"SELECT count_if({c} IS NULL) FROM {t}")


def _uq(t, c):
    return ("unique", c, f"SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")


_STAGING_MODELS_SQL = warehouse.UNION_SQL.rstrip() + "\n" + _models_sql([
    ("stg_green_tripdata", [_nn("stg_green", "vendor_id"), _nn("stg_green", "pickup_datetime")]),
    ("stg_yellow_tripdata", [_nn("stg_yellow", "vendor_id"), _nn("stg_yellow", "pickup_datetime")]),
])


@query("dq_staging_models", covers="DQ-1", sql=_STAGING_MODELS_SQL)
def dq_staging_models(spark, sf_dir):
    checks = [Q.not_null("vendor_id"), Q.not_null("pickup_datetime")]
    return Q.run_models([("stg_green_tripdata", warehouse.stg_green(spark, sf_dir), checks),
                         ("stg_yellow_tripdata", warehouse.stg_yellow(spark, sf_dir), checks)])


INT_NOT_NULL = ["trip_id", "vendor_id", "service_type", "pickup_datetime", "total_amount"]
_INT_MODEL_SQL = warehouse.INT_SQL.rstrip() + ",\nvendors AS (SELECT DISTINCT vendor_id FROM int_trips)\n" + _models_sql([
    ("int_trips", [_uq("int_trips", "trip_id"), *[_nn("int_trips", c) for c in INT_NOT_NULL],
                   ("accepted_values", "service_type",
                    "SELECT count_if(service_type NOT IN ('Green', 'Yellow')) FROM int_trips")]),
    ("dim_zones", [_uq("zones", "location_id"), _nn("zones", "location_id")]),
    ("dim_vendors", [_uq("vendors", "vendor_id"), _nn("vendors", "vendor_id")]),
    ("payment_type_lookup", [_uq("payment_types", "payment_type"), _nn("payment_types", "payment_type")]),
])


@query("dq_int_trips_and_dimensions", covers="DQ-1 DQ-2 DQ-3", sql=_INT_MODEL_SQL)
def dq_int_trips_and_dimensions(spark, sf_dir):
    it = materialized(warehouse.int_trips(spark, sf_dir), "int_trips")
    key = lambda c: [Q.unique(c), Q.not_null(c)]
    return Q.run_models([
        ("int_trips", it, [Q.unique("trip_id"), *[Q.not_null(c) for c in INT_NOT_NULL],
                           Q.accepted_values("service_type", ["Green", "Yellow"])]),
        ("dim_zones", warehouse.dim_zones(spark, sf_dir), key("location_id")),
        ("dim_vendors", warehouse.dim_vendors(it), key("vendor_id")),
        ("payment_type_lookup", D.payment_types(spark), key("payment_type")),
    ])


_REPORTS_SQL = warehouse.MART_SQL.rstrip() + f""",
top_zone AS (
  SELECT pickup_zone, sum(revenue_monthly_total_amount) AS total_revenue FROM mart
  WHERE service_type = 'Green' AND extract(year FROM revenue_month) = {warehouse.TOP_ZONE_YEAR}
  GROUP BY pickup_zone ORDER BY total_revenue DESC, pickup_zone ASC LIMIT 1),
month_trips AS (
  SELECT sum(total_monthly_trips) AS total_trips FROM mart
  WHERE service_type = 'Green' AND extract(year FROM revenue_month) = {warehouse.TRIPS_MONTH[0]}
    AND extract(month FROM revenue_month) = {warehouse.TRIPS_MONTH[1]})
""" + _models_sql([
    ("top_green_zone_revenue", [
        ("expression_is_true", "total_revenue >= 0", "SELECT count_if(NOT (total_revenue >= 0)) FROM top_zone"),
        ("row_count", "*", "SELECT abs(count(*) - 1) FROM top_zone"),
        _nn("top_zone", "pickup_zone"), _nn("top_zone", "total_revenue")]),
    ("total_green_trips_in_month", [
        ("expression_is_true", "total_trips >= 0", "SELECT count_if(NOT (total_trips >= 0)) FROM month_trips"),
        ("row_count", "*", "SELECT abs(count(*) - 1) FROM month_trips"),
        _nn("month_trips", "total_trips")]),
])


@query("dq_report_marts", covers="DQ-6 DQ-7 DQ-1", sql=_REPORTS_SQL)
def dq_report_marts(spark, sf_dir):
    mart = materialized(warehouse.monthly_zone_revenue(warehouse.fct_trips(spark, sf_dir)), "monthly_zone_revenue")
    top = warehouse.top_zone_for_year(mart, "Green", warehouse.TOP_ZONE_YEAR)
    month = warehouse.trips_in_month(mart, "Green", *warehouse.TRIPS_MONTH)
    return Q.run_models([
        ("top_green_zone_revenue", top, [Q.expression_is_true("total_revenue >= 0"), Q.row_count(1),
                                         Q.not_null("pickup_zone"), Q.not_null("total_revenue")]),
        ("total_green_trips_in_month", month, [Q.expression_is_true("total_trips >= 0"), Q.row_count(1),
                                               Q.not_null("total_trips")]),
    ])


# --- the enforced fact load: contract and tests before the write, then read back ------------------------

@query("m4_fct_loaded", covers="DQ-12 DQ-14 SNK-7 SNK-8 SNK-9 SNK-21", sql=warehouse.FCT_SQL + "SELECT * FROM fct")
def m4_fct_loaded(spark, sf_dir):
    import uuid

    from meterstar.operators.load import TableFolder
    from meterstar.session import scratch_path
    table = TableFolder(spark, scratch_path(spark, "tables", f"fct-{uuid.uuid4().hex[:12]}"), partition_by="pickup_month")
    warehouse.load_fct(spark, sf_dir, table)
    # a second run takes the last month again: the merge replaces those trips by themselves
    warehouse.load_fct(spark, sf_dir, table, lookback="30 days")
    return table.read().select(*warehouse.FCT_COLUMNS)
