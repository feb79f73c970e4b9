"""Report queries over the trip binding (Q-M1-*, Q-M3-*, Q-M6-*, Q-DLT-1..3).

Parameters sit at the top; every query scans the whole trip binding (no id subsets).
Top-1 queries get an explicit tie-break (the reference relies on engine order for ties).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from meterstar.functions import expr as X
from meterstar.operators import dedup, star
from meterstar.operators import load
from meterstar.plans.registry import query
from meterstar.session import scratch_path
from meterstar.sources import driver_tables as D
from meterstar.sources import files

# Report parameters (dates inside the 1995-2001 order range of the driver tables).
MONTH_START, MONTH_END = "1996-11-01", "1996-12-01"
MONTH_LAST_DAY = "1996-11-30"
REVENUE_DAY = "1996-11-18"
COUNT_DAY = "1996-11-15"
TIP_FROM_ZONE = "NATION_7"
VENDOR_PERIOD = ("1996-03-01", "1996-03-15")

T = D.with_sql(D.TRIPS_SQL)
TZ = D.with_sql(D.TRIPS_SQL, D.ZONES_SQL)


# Q-M1-3: trips <= 1 mile picked up in a month (half-open range).
@query("m1_short_trips_in_month", covers="Q-M1-3 FLT-2 FLT-6 AG-1", sql=T + f"""
SELECT count(*) AS trips FROM trips
WHERE pickup_datetime >= TIMESTAMP '{MONTH_START}' AND pickup_datetime < TIMESTAMP '{MONTH_END}'
  AND trip_distance <= 1""")
def m1_short_trips_in_month(spark, sf_dir):
    t = D.trips(spark, sf_dir, ["pickup_datetime", "trip_distance"])
    return (t.where(X.half_open("pickup_datetime", MONTH_START, MONTH_END) & (F.col("trip_distance") <= 1))
            .agg(F.count(F.lit(1)).alias("trips")))


# Q-M1-4: pickup day with the longest trip under 100 miles.
@query("m1_longest_trip_day", covers="Q-M1-4 FN-12 AG-6 AG-8 SRT-1", sql=T + """
SELECT CAST(pickup_datetime AS DATE) AS trip_date, max(trip_distance) AS max_distance
FROM trips WHERE trip_distance < 100
GROUP BY 1 ORDER BY max_distance DESC, trip_date ASC LIMIT 1""")
def m1_longest_trip_day(spark, sf_dir):
    t = D.trips(spark, sf_dir, ["pickup_datetime", "trip_distance"]).where(F.col("trip_distance") < 100)
    daily = t.groupBy(F.to_date("pickup_datetime").alias("trip_date")).agg(
        F.max("trip_distance").alias("max_distance"))
    return dedup.top_n(daily, [F.col("max_distance").desc(), F.col("trip_date").asc_nulls_last()], 1)


# Q-M1-5: pickup zone with the largest total amount on one day.
@query("m1_top_revenue_zone_on_day", covers="Q-M1-5 JN-1 FLT-5 AG-4 FN-16 SRT-1", sql=TZ + f"""
SELECT z.zone AS zone, CAST(round(sum(t.total_amount), 3) AS DECIMAL(38,3)) AS total_amount_sum
FROM trips t JOIN zones z ON z.location_id = t.pickup_location_id
WHERE CAST(t.pickup_datetime AS DATE) = DATE '{REVENUE_DAY}'
GROUP BY z.zone ORDER BY total_amount_sum DESC, zone ASC LIMIT 1""")
def m1_top_revenue_zone_on_day(spark, sf_dir):
    t = D.trips(spark, sf_dir, ["pickup_datetime", "pickup_location_id", "total_amount"]).where(
        X.on_day("pickup_datetime", REVENUE_DAY))
    t = star.enrich(t, D.zones(spark, sf_dir), "pickup_location_id", "location_id", {"zone": "zone"}, how="inner")
    g = t.groupBy("zone").agg(F.round(F.sum("total_amount"), 3).cast("decimal(38,3)").alias("total_amount_sum"))
    return dedup.top_n(g, [F.col("total_amount_sum").desc(), F.col("zone").asc_nulls_last()], 1)


# Q-M1-6: for pickups in one zone (scalar subquery on the zone name) during a month,
# the dropoff zone with the largest single tip.
@query("m1_largest_tip_dropoff_zone", covers="Q-M1-6 JN-1 JN-5 FLT-3 FLT-10 AG-6 FN-16", sql=TZ + f"""
SELECT z.zone AS drop_off_zone, round(max(t.tip_amount), 3) AS tip_amount
FROM trips t JOIN zones z ON z.location_id = t.dropoff_location_id
WHERE CAST(t.pickup_datetime AS DATE) >= DATE '{MONTH_START}'
  AND CAST(t.pickup_datetime AS DATE) <= DATE '{MONTH_LAST_DAY}'
  AND t.pickup_location_id = (SELECT location_id FROM zones WHERE zone = '{TIP_FROM_ZONE}')
GROUP BY z.zone ORDER BY tip_amount DESC, drop_off_zone ASC LIMIT 1""")
def m1_largest_tip_dropoff_zone(spark, sf_dir):
    zones = D.zones(spark, sf_dir)
    from_zone = zones.where(F.col("zone") == TIP_FROM_ZONE).select("location_id").scalar()
    t = D.trips(spark, sf_dir, ["pickup_datetime", "pickup_location_id", "dropoff_location_id", "tip_amount"])
    t = t.where(X.day_range("pickup_datetime", MONTH_START, MONTH_LAST_DAY) & (F.col("pickup_location_id") == from_zone))
    t = star.enrich(t, zones, "dropoff_location_id", "location_id", {"zone": "drop_off_zone"}, how="inner")
    g = t.groupBy("drop_off_zone").agg(F.round(F.max("tip_amount"), 3).alias("tip_amount"))
    return dedup.top_n(g, [F.col("tip_amount").desc(), F.col("drop_off_zone").asc_nulls_last()], 1)


# Q-M3-1 / Q-M3-9: row count of the whole table.
@query("m3_row_count", covers="Q-M3-1 Q-M3-9 AG-1", sql=T + "SELECT count(*) AS row_count FROM trips")
def m3_row_count(spark, sf_dir):
    # a trip is a lineitem row, so the count is in the footers of that table
    return files.footer_table(spark, f"{sf_dir}/lineitem.parquet").agg(F.count(F.lit(1)).alias("row_count"))


# Q-M3-2: distinct pickup locations (exact).
@query("m3_distinct_pickup_locations", covers="Q-M3-2 AG-3", sql=T + """
SELECT count(DISTINCT pickup_location_id) AS distinct_pickup_locations FROM trips""")
def m3_distinct_pickup_locations(spark, sf_dir):
    # per-location counts are a few rows; the fact table is only counted per supplier key, map-side first
    return D.trips_per_pickup_location(spark, sf_dir).agg(
        F.count("pickup_location_id").alias("distinct_pickup_locations"))


# Q-M3-3: two-column projection (the scan reads only these columns: ReadSchema in the plan).
@query("m3_two_column_scan", covers="Q-M3-3 PRJ-6", sql=T + """
SELECT pickup_location_id, dropoff_location_id FROM trips""")
def m3_two_column_scan(spark, sf_dir):
    return D.trips(spark, sf_dir, ["pickup_location_id", "dropoff_location_id"])


# Q-M3-4: zero-fare trips.
@query("m3_zero_fare_trips", covers="Q-M3-4 FLT-6 AG-1", sql=T + """
SELECT count(*) AS zero_fare_trips FROM trips WHERE fare_amount = 0""")
def m3_zero_fare_trips(spark, sf_dir):
    t = D.trips(spark, sf_dir, ["fare_amount"]).where(F.col("fare_amount") == 0)
    return t.agg(F.count(F.lit(1)).alias("zero_fare_trips"))


# Q-M3-6: distinct vendors in a period. The predicate compares the timestamp with date strings,
# so the "inclusive" upper day only keeps its midnight (reproduced literally).
@query("m3_distinct_vendors_in_period", covers="Q-M3-6 AG-7 FLT-4", sql=T + f"""
SELECT DISTINCT vendor_id FROM trips
WHERE pickup_datetime BETWEEN TIMESTAMP '{VENDOR_PERIOD[0]}' AND TIMESTAMP '{VENDOR_PERIOD[1]}'""")
def m3_distinct_vendors_in_period(spark, sf_dir):
    lo, hi = (F.lit(d).cast("timestamp_ntz") for d in VENDOR_PERIOD)
    t = D.trips(spark, sf_dir, ["vendor_id", "pickup_datetime"])
    return t.where(F.col("pickup_datetime").between(lo, hi)).select("vendor_id").distinct()


# Q-M6-3: trips picked up on one day.
@query("m6_trips_on_day", covers="Q-M6-3 FLT-5 AG-1", sql=T + f"""
SELECT count(*) AS trips FROM trips WHERE CAST(pickup_datetime AS DATE) = DATE '{COUNT_DAY}'""")
def m6_trips_on_day(spark, sf_dir):
    t = D.trips(spark, sf_dir, ["pickup_datetime"]).where(X.on_day("pickup_datetime", COUNT_DAY))
    return t.agg(F.count(F.lit(1)).alias("trips"))


# Q-M6-4: longest trip in hours (top-1 by the computed difference).
@query("m6_longest_trip_hours", covers="Q-M6-4 FN-13 FN-17 SRT-3", sql=T + """
SELECT pickup_datetime, dropoff_datetime,
       (epoch(dropoff_datetime) - epoch(pickup_datetime)) / 3600.0 AS diff_hours
FROM trips ORDER BY diff_hours DESC, pickup_datetime ASC LIMIT 1""")
def m6_longest_trip_hours(spark, sf_dir):
    t = D.trips(spark, sf_dir, ["pickup_datetime", "dropoff_datetime"])
    t = t.withColumn("diff_hours", X.hours_between("pickup_datetime", "dropoff_datetime"))
    return dedup.top_n(t, [F.col("diff_hours").desc(), F.col("pickup_datetime").asc_nulls_last()], 1)


# Q-M6-6: least-used pickup zones, ties kept (DENSE_RANK ascending = 1).
@query("m6_least_used_pickup_zones", covers="Q-M6-6 JN-1 AG-1 AG-8 WN-3 FLT-12", sql=TZ + """
, zone_counts AS (
  SELECT z.zone AS pickup_zone, count(*) AS cnt
  FROM trips t JOIN zones z ON t.pickup_location_id = z.location_id GROUP BY z.zone),
by_rank AS (SELECT pickup_zone, cnt, dense_rank() OVER (ORDER BY cnt) AS r FROM zone_counts)
SELECT pickup_zone, cnt FROM by_rank WHERE r = 1""")
def m6_least_used_pickup_zones(spark, sf_dir):
    t = star.enrich(D.trips_per_pickup_location(spark, sf_dir), D.zones(spark, sf_dir), "pickup_location_id",
                    "location_id", {"zone": "pickup_zone"}, how="inner")
    counts = t.groupBy("pickup_zone").agg(F.sum("trips").cast("bigint").alias("cnt"))
    return dedup.lowest_with_ties(counts, "cnt")


# Q-M6-6 through the SQL API: temp views over the bound tables and Spark SQL. "Rank 1 with ties"
# is the zones whose count equals the smallest count (a one-row aggregate compared in HAVING), so
# no unpartitioned window is needed.
@query("m6_least_used_pickup_zones_sql", covers="Q-M6-6 SNK-19 SRC-18 PRJ-8 PRJ-9 FLT-10 SRT-2", sql=TZ + """
, per_zone AS (
  SELECT z.zone AS pickup_zone, count(*) AS cnt
  FROM trips t JOIN zones z ON t.pickup_location_id = z.location_id GROUP BY z.zone)
SELECT pickup_zone, cnt FROM per_zone WHERE cnt = (SELECT min(cnt) FROM per_zone)""")
def m6_least_used_pickup_zones_sql(spark, sf_dir):
    import uuid

    from meterstar.sources.catalog import view
    tag = uuid.uuid4().hex[:8]          # view names unique per call: concurrent queries do not collide
    view(D.trips_per_pickup_location(spark, sf_dir), f"pickups_{tag}")
    view(D.zones(spark, sf_dir), f"zone_dim_{tag}")
    return spark.sql(f"""
        WITH zone_use AS (
            SELECT d.`zone` AS pickup_zone, CAST(SUM(p.trips) AS BIGINT) AS cnt
            FROM pickups_{tag} AS p
            INNER JOIN zone_dim_{tag} AS d ON d.location_id = p.pickup_location_id
            GROUP BY 1)
        SELECT pickup_zone, cnt
        FROM zone_use
        WHERE cnt = (SELECT MIN(cnt) FROM zone_use)
        ORDER BY 2, 1""")


# Q-DLT-1..3: date span, credit-card share, total tips (questions without query text).
@query("dlt_trip_date_span", covers="Q-DLT-1 AG-11", sql=T + """
SELECT CAST(min(pickup_datetime) AS DATE) AS first_day, CAST(max(pickup_datetime) AS DATE) AS last_day FROM trips""")
def dlt_trip_date_span(spark, sf_dir):
    t = D.trips(spark, sf_dir, ["pickup_datetime"])
    return t.agg(F.to_date(F.min("pickup_datetime")).alias("first_day"),
                 F.to_date(F.max("pickup_datetime")).alias("last_day"))


@query("dlt_credit_card_share", covers="Q-DLT-2 AG-11", sql=T + """
SELECT 100.0 * CAST(count_if(payment_type = 1) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS credit_card_pct FROM trips""")
def dlt_credit_card_share(spark, sf_dir):
    t = D.trips(spark, sf_dir, ["payment_type"])
    return t.agg((F.lit(100.0) * X.ratio(F.count_if(F.col("payment_type") == 1), F.count(F.lit(1))))
                 .alias("credit_card_pct"))


@query("dlt_total_tips", covers="Q-DLT-3 AG-4 AG-11", sql=T + """
SELECT CAST(sum(tip_amount) AS DECIMAL(38,4)) AS total_tips FROM trips""")
def dlt_total_tips(spark, sf_dir):
    t = D.trips(spark, sf_dir, ["tip_amount"])
    return t.agg(F.sum("tip_amount").cast("decimal(38,4)").alias("total_tips"))


# Q-M6-2: rewrite the trips as Parquet parts, read back (SNK-1). Four parts as asked while the data fits
# four writers; beyond that the number of parts follows the bytes of the scanned tables.
REWRITE_PARTS = 4


@query("m6_rewrite_four_parts", covers="Q-M6-2 SNK-1 SRC-1", sql=T + """
SELECT vendor_id, pickup_datetime, dropoff_datetime, pickup_location_id, total_amount FROM trips""")
def m6_rewrite_four_parts(spark, sf_dir):
    import uuid
    t = D.trips(spark, sf_dir, ["vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
                                "total_amount"])
    path = scratch_path(spark, "tables", f"trips_4parts-{uuid.uuid4().hex[:12]}")
    size = int(str(D.table(spark, sf_dir, "lineitem")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    load.write_files(t, path, load.parts_for(size, least=REWRITE_PARTS))
    return spark.read.schema(t.schema).parquet(path)


# Q-M3-6, second half: the same question on a table partitioned by pickup day and clustered by vendor; the
# scan prunes to the period's folders (PartitionFilters in the plan).
@query("m3_distinct_vendors_partitioned", covers="Q-M3-6 SNK-12 SNK-13 FLT-4", sql=T + f"""
SELECT DISTINCT vendor_id FROM trips
WHERE pickup_datetime BETWEEN TIMESTAMP '{VENDOR_PERIOD[0]}' AND TIMESTAMP '{VENDOR_PERIOD[1]}'""")
def m3_distinct_vendors_partitioned(spark, sf_dir):
    import uuid
    t = D.trips(spark, sf_dir, ["vendor_id", "pickup_datetime", "trip_distance"])
    path = scratch_path(spark, "tables", f"trips_by_day-{uuid.uuid4().hex[:12]}")
    load.write_partitioned(t, path, "pickup_datetime", cluster_by=["vendor_id"])
    part = spark.read.parquet(path)
    pruned = part.where(load.pruned_range("pickup_datetime", *VENDOR_PERIOD, inclusive_end=True))
    return pruned.select("vendor_id").distinct()
