"""Physical layouts and planner statistics: bucketed tables, analysed tables, footers, bounded previews."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.functions import expr as X
from meterstar.operators import load
from meterstar.plans.registry import query
from meterstar.session import scratch_path
from meterstar.sources import catalog as C
from meterstar.sources import driver_tables as D
from meterstar.sources import files

DAY = "1996-07-15"
T = D.with_sql(D.TRIPS_SQL)


def _name(of: str) -> str:
    return f"{of}_{uuid.uuid4().hex[:12]}"


def bucketed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips' fares with their orders' payment, both tables bucketed by the order key: the join has no exchange."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sides = [("lineitem", "l_orderkey", "l_extendedprice"), ("orders", "o_orderkey", "o_orderpriority")]
    lines, orders = (load.write_bucketed(D.table(spark, sf_dir, t).select(key, value), _name(t),
                                         scratch_path(spark, "bucketed", _name(t)), [key], n) for t, key, value in sides)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_type"), F.col("l_extendedprice").cast(X.MONEY).alias("fare_amount"))


@query("bucketed_fares_by_payment", covers="SNK-13 SRC-18 JN-2", sql=T + """
SELECT payment_type, count(*) AS trips, CAST(sum(fare_amount) AS DECIMAL(38,3)) AS total_fare FROM trips GROUP BY payment_type""")
def bucketed_fares_by_payment(spark, sf_dir):
    return bucketed_trips(spark, sf_dir).groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("fare_amount").cast("decimal(38,3)").alias("total_fare"))


def day_by_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of one day by vendor, over analysed named tables.

    Only the orders of that day matter. From the statistics Spark knows that few are left and, once the fact is
    large enough, sends a bloom filter of their keys to its scan, before it is shuffled for the join.
    """
    lines = C.external(spark, _name("lineitem"), f"{sf_dir}/lineitem.parquet", ["l_orderkey"])
    orders = C.external(spark, _name("orders"), f"{sf_dir}/orders.parquet", ["o_orderkey", "o_orderdate"])
    trips = lines.join(orders.where(X.on_day("o_orderdate", DAY)), F.col("l_orderkey") == F.col("o_orderkey"))
    vendor = F.when(F.col("l_suppkey") % 3 == 0, 1).when(F.col("l_suppkey") % 3 == 1, 2).otherwise(4).cast("int")
    return trips.groupBy(vendor.alias("vendor_id")).agg(
        F.count(F.lit(1)).alias("trips"), F.sum(F.col("l_extendedprice").cast(X.MONEY)).cast("decimal(38,3)").alias("total_fare"))


@query("analyzed_day_by_vendor", covers="JN-1 SRC-18 Q-M1-5 Q-M6-3", sql=T + f"""
SELECT vendor_id, count(*) AS trips, CAST(sum(fare_amount) AS DECIMAL(38,3)) AS total_fare FROM trips
WHERE CAST(pickup_datetime AS DATE) = DATE '{DAY}' GROUP BY vendor_id""")
def analyzed_day_by_vendor(spark, sf_dir):
    return day_by_vendor(spark, sf_dir)


@query("footer_order_keys", covers="Q-M3-9 SNK-8 AG-6", sql="""
SELECT count(*) AS row_count, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders""")
def footer_order_keys(spark, sf_dir):
    """Row count and key range of a table from its footers alone."""
    return files.footer_table(spark, f"{sf_dir}/orders.parquet").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query("calendar_day_orders", covers="SRC-19 AG-6 JN-1", sql="""
WITH span AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
n AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)
SELECT days.day, coalesce(n.n, 0) AS orders FROM days LEFT JOIN n ON n.day = days.day""")
def calendar_day_orders(spark, sf_dir):
    """Orders of every day between the first and the last, days without any included (a generated range of days)."""
    day = F.col("o_orderdate").cast("date")
    orders = D.table(spark, sf_dir, "orders").select(day.alias("day"))
    lo, hi = orders.agg(F.min("day"), F.max("day")).first()
    n = (hi - lo).days + 1 if lo else 0
    days = files.generated_range(spark, n).select(F.date_add(F.lit(lo).cast("date"), F.col("id").cast("int")).alias("day"))
    found = orders.where("day IS NOT NULL").groupBy("day").agg(F.count(F.lit(1)).alias("orders"))
    return days.join(found, "day", "left").select("day", F.coalesce("orders", F.lit(0)).alias("orders"))


@query("preview_row_count", covers="SNK-20 SRT-5", sql=T + "SELECT least(count(*), 5) AS preview_rows FROM trips")
def preview_row_count(spark, sf_dir):
    """How many rows a preview of the trips shows: any five (LIMIT without an order, so which ones is left open)."""
    return D.trips(spark, sf_dir, ["vendor_id"]).limit(5).agg(F.count(F.lit(1)).alias("preview_rows"))
