"""Interval pipeline (Q-M5-*): append ingestion -> interval-replaced staging -> interval-replaced
daily report.

A run covers a half-open window [start, end). The registered queries are full runs, which have no
window and take every row; ``rerun_report`` replaces one month of an existing report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.functions import expr as X
from meterstar.operators import dedup, load, star
from meterstar.plans.registry import query
from meterstar.session import materialized
from meterstar.sources import driver_tables as D

FULL_RUN = None                              # no window: every row
RERUN = ("1997-03-01", "1997-04-01")
RUN_STAMP = "2024-01-01 00:00:00"            # extracted_at of this run (a run argument, not now())

STG_KEY = ["pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id", "fare_amount"]
# the reference orders by a key column (arbitrary survivor); the two remaining columns make it total
STG_ORDER = ["pickup_datetime", "taxi_type", "payment_type_name"]


def ingestion_trips(spark: SparkSession, sf_dir: str, run_stamp: str = RUN_STAMP) -> DataFrame:
    """Append-ingested trips tagged with taxi type and load time (PRJ-2, PRJ-3)."""
    t = D.trips(spark, sf_dir, ["pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
                                "fare_amount", "payment_type", "service_type"])
    return (t.withColumn("taxi_type", F.lower("service_type")).drop("service_type")
            .withColumn("extracted_at", F.lit(run_stamp).cast("timestamp_ntz")))


def staging_trips(spark: SparkSession, sf_dir: str, window=FULL_RUN, ingested: DataFrame | None = None) -> DataFrame:
    t = ingested if ingested is not None else ingestion_trips(spark, sf_dir)
    if window is not None:
        t = t.where(load.in_window("pickup_datetime", *window))
    t = star.enrich(t, D.payment_names(spark), "payment_type", "payment_type_id",
                    {"payment_type_name": "payment_type_name"}, how="left")
    t = t.select("pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
                 "fare_amount", "taxi_type", "payment_type_name")
    return dedup.keep_first(t, STG_KEY, STG_ORDER)


def trips_report(staging: DataFrame, window=FULL_RUN) -> DataFrame:
    s = staging if window is None else staging.where(load.in_window("pickup_datetime", *window))
    return s.groupBy(F.to_date("pickup_datetime").alias("trip_date"), F.col("taxi_type"),
                     F.col("payment_type_name").alias("payment_type")).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum("fare_amount").cast("decimal(38,3)").alias("total_fare"),
        X.mean("fare_amount").alias("avg_fare"))


def rerun_report(spark: SparkSession, sf_dir: str, window=RERUN) -> DataFrame:
    """Replace the window's days of a full report with a re-run of that window. The staging is built and
    written once, as a run does; the re-run reads only its window of it."""
    staging = materialized(staging_trips(spark, sf_dir), "interval_staging")
    full = trips_report(staging)
    redo = trips_report(staging, window)
    full = full.withColumn("trip_date", F.col("trip_date").cast("timestamp_ntz"))
    redo = redo.withColumn("trip_date", F.col("trip_date").cast("timestamp_ntz"))
    out = load.replace_interval(full, redo, "trip_date", *window)
    return out.withColumn("trip_date", F.col("trip_date").cast("date"))


# The oracle picks each survivor as the smallest (taxi type, payment name) of a group of equal keys.
def _staging_sql(window) -> str:
    bounds = "" if window is None else f"WHERE pickup_datetime >= TIMESTAMP '{window[0]}' AND pickup_datetime < TIMESTAMP '{window[1]}'"
    return D.with_sql(D.TRIPS_SQL, D.PAYMENT_NAMES_SQL, f"""
named AS (
  SELECT {', '.join(STG_KEY)},
         {{'a': lower(service_type), 'b': payment_type_name IS NOT NULL, 'c': payment_type_name}} AS rest
  FROM (SELECT * FROM trips {bounds}) LEFT JOIN payment_names ON payment_type_id = payment_type),
staging AS (
  SELECT {', '.join(STG_KEY)}, min(rest).a AS taxi_type, min(rest).c AS payment_type_name
  FROM named GROUP BY {', '.join(STG_KEY)})""")


def _report_sql(src: str, window) -> str:
    bounds = "true" if window is None else f"trip_date >= DATE '{window[0]}' AND trip_date < DATE '{window[1]}'"
    return f"""
  SELECT trip_date, taxi_type, payment_type, count(*) AS trip_count,
         CAST(sum(fare) AS DECIMAL(38,3)) AS total_fare, CAST(sum(fare) AS DOUBLE) / count(fare) AS avg_fare
  FROM (SELECT pickup_datetime::DATE AS trip_date, taxi_type, payment_type_name AS payment_type, fare_amount AS fare FROM {src})
  WHERE {bounds} GROUP BY ALL"""


@query("m5_staging_trips", covers="Q-M5-stg JN-4 WN-1", sql=_staging_sql(FULL_RUN) + "SELECT * FROM staging")
def q_staging_trips(spark, sf_dir):
    return staging_trips(spark, sf_dir)


@query("m5_ingested_trips", covers="PRJ-2 PRJ-3", sql=D.with_sql(D.TRIPS_SQL) + f"""
SELECT pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, fare_amount, payment_type,
       lower(service_type) AS taxi_type, TIMESTAMP '{RUN_STAMP}' AS extracted_at FROM trips""")
def q_ingested_trips(spark, sf_dir):
    return ingestion_trips(spark, sf_dir)


@query("m5_trips_report", covers="Q-M5-rep AG-1 AG-4 AG-5 AG-8", sql=_staging_sql(FULL_RUN) + _report_sql("staging", FULL_RUN))
def q_trips_report(spark, sf_dir):
    return trips_report(staging_trips(spark, sf_dir))


@query("m5_trips_report_rerun_month", covers="SNK-10 Q-M5-rep", sql=_staging_sql(FULL_RUN) + f""",
full_report AS ({_report_sql("staging", FULL_RUN)}),
redo AS ({_report_sql("staging", RERUN)})
SELECT * FROM full_report WHERE (trip_date >= DATE '{RERUN[0]}' AND trip_date < DATE '{RERUN[1]}') IS NOT TRUE
UNION ALL SELECT * FROM redo""")
def q_trips_report_rerun(spark, sf_dir):
    return rerun_report(spark, sf_dir)


# --- persisted interval run (SNK-10 into day-partitioned tables) -------------------------------------

def run_window(spark: SparkSession, sf_dir: str, window, staging_table, report_table) -> None:
    """One run of the interval pipeline for ``window`` = [start, end): the staging rows of the window
    replace the window in the staging table, then the report days of the window are recomputed from
    the persisted staging table and replace those days in the report. Tables partitioned by day
    rewrite only the window's days. A side of the window that is None is open."""
    stg = staging_trips(spark, sf_dir, window).withColumn("pickup_date", F.to_date("pickup_datetime"))
    load.materialize(spark, stg, "time_interval", staging_table, incremental_key="pickup_datetime", window=window,
                     period="day" if staging_table.partition_by == "pickup_date" else None)
    rep = trips_report(staging_table.read(), window).withColumn("report_date", F.col("trip_date"))
    load.materialize(spark, rep, "time_interval", report_table, incremental_key="trip_date", window=window,
                     period="day" if report_table.partition_by == "report_date" else None)
