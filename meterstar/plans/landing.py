"""Queries that start from landed files: a given table is written to the shared folder in the form in
which a feed lands, read back through the reader, and compared with the given table itself."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterstar.functions import expr as X
from meterstar.plans import warehouse
from meterstar.plans.registry import query
from meterstar.session import scratch_path
from meterstar.sources import driver_tables as D
from meterstar.sources import files
from meterstar.sources import nested as N

ZONE_FIELDS = T.StructType([T.StructField("location_id", T.IntegerType()), T.StructField("borough", T.StringType()),
                            T.StructField("zone", T.StringType()), T.StructField("service_zone", T.StringType())])
FEED = ["l_orderkey", "l_linenumber", "pickup_datetime", "fare_amount"]
MONTH_FILE = "kind={kind}/month={month}"
PAGE_ROWS = 1000
SAMPLE = ("1996-01-01", "1996-02-01")


def _landing(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, "landing", f"{name}-{uuid.uuid4().hex[:12]}")


@query("landing_seed_zones", covers="SRC-4 SRC-5 SRC-6 SRC-7", sql=D.with_sql(D.ZONES_SQL) + "SELECT * FROM zones")
def landing_seed_zones(spark, sf_dir) -> DataFrame:
    path = _landing(spark, "zones")
    D.zones(spark, sf_dir).write.option("header", True).option("compression", "gzip").csv(path)
    return files.read_seed(spark, path, ZONE_FIELDS, ["location_id"])


CUSTOMER_CSV = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_nationkey", T.LongType()),
                             T.StructField("c_acctbal", T.DecimalType(18, 2))])


@query("landing_csv_customers", covers="SRC-4 SRC-5 SRC-6", sql="""
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal FROM customer""")
def landing_csv_customers(spark, sf_dir) -> DataFrame:
    path = _landing(spark, "customers")
    c = D.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"), F.lit("surplus").alias("note"))
    c.write.option("header", True).option("compression", "gzip").csv(path)
    return files.read_csv(spark, path, CUSTOMER_CSV, mode="FAILFAST")


def _monthly_trips(spark, sf_dir) -> tuple[str, str, str]:
    """Trips with a pickup time as one folder of files per kind and month; (root, first day, last day)."""
    root = _landing(spark, "trips")
    t = D.trips(spark, sf_dir, [*FEED, "service_type"]).where("pickup_datetime IS NOT NULL")
    t = t.select(*FEED, F.lower("service_type").alias("kind"), F.date_format("pickup_datetime", "yyyy-MM").alias("month"))
    (t.repartitionByRange("kind", "month", F.xxhash64("l_orderkey", "l_linenumber")).write.partitionBy("kind", "month").parquet(root))
    days = D.table(spark, sf_dir, "orders").agg(F.date_format(F.min("o_orderdate"), "yyyy-MM"), F.date_format(F.max("o_orderdate"), "yyyy-MM")).first()
    return root, f"{days[0]}-01", f"{days[1]}-28"


_FEED_SQL = f"""SELECT {', '.join(FEED)}, lower(service_type) AS taxi_type FROM trips WHERE pickup_datetime IS NOT NULL"""


@query("landing_monthly_feeds", covers="SRC-8 SRC-9 PRJ-2 SET-2", sql=D.with_sql(D.TRIPS_SQL) + _FEED_SQL)
def landing_monthly_feeds(spark, sf_dir) -> DataFrame:
    root, first, last = _monthly_trips(spark, sf_dir)
    return read_landed_months(spark, root, first, last)


def read_landed_months(spark: SparkSession, root: str, first: str, last: str) -> DataFrame:
    # a feed without trips in a month has no file for it
    return files.read_monthly_feeds(spark, root, first, last, ["green", "yellow"], pattern=MONTH_FILE,
                                    ignore_missing=True).select(*FEED, "taxi_type")


@query("landing_rows_per_file", covers="SRC-2 FN-20", sql=D.with_sql(D.TRIPS_SQL) + """
SELECT lower(service_type) || '/' || strftime(pickup_datetime, '%Y-%m') AS landed, count(*) AS row_count
FROM trips WHERE pickup_datetime IS NOT NULL GROUP BY 1""")
def landing_rows_per_file(spark, sf_dir) -> DataFrame:
    root, _, _ = _monthly_trips(spark, sf_dir)
    rows = files.with_source_file(files.read_parquet(spark, f"{root}/kind=*/month=*"), "landed", r"kind=(\w+/month=[0-9-]+)")
    return (rows.groupBy(F.replace("landed", F.lit("month="), F.lit("")).alias("landed")).agg(F.count(F.lit(1)).alias("row_count")))


RECORD = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()), T.StructField("o_orderpriority", T.StringType())])


@query("landing_paged_orders", covers="SRC-15 FN-19", sql="""
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders""")
def landing_paged_orders(spark, sf_dir) -> DataFrame:
    """Orders as an interface would page them: PAGE_ROWS key values a page, an empty page at the end."""
    path = _landing(spark, "orders")
    o = D.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    # page numbers without gaps: the position of a page among the pages that have rows
    slot = F.floor(F.col("o_orderkey") / PAGE_ROWS).cast("int")
    slots = o.select(slot.alias("slot")).distinct()
    last = slots.agg(F.max("slot").alias("m")).scalar()
    filled = spark.range(1).select(F.explode(F.sequence(F.lit(0), last)).alias("slot"))
    pages = (o.withColumn("slot", slot).groupBy("slot").agg(F.to_json(F.collect_list(F.struct("o_orderkey", "o_custkey", "o_orderpriority"))).alias("value")))
    # a slot without orders is a page with one record of nulls, as an empty page would end the feed
    pages = filled.join(pages, "slot", "left").select((F.col("slot") + 1).alias("page"), F.coalesce("value", F.lit("[{}]")).alias("value"))
    end = spark.range(1).select((last + 2).alias("page"), F.lit("[]").alias("value"))
    pages.unionByName(end).repartition("page").write.partitionBy("page").text(path)
    got = N.read_paged_records(spark, path, RECORD)
    return got.where("o_orderkey IS NOT NULL").select("o_orderkey", "o_custkey", "o_orderpriority")


# Texts as a feed delivers them: every third line number is not a number, the others have a decimal point.
@query("text_numbers_to_int", covers="FN-18 FN-2", sql="""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(trunc(l_quantity) AS INTEGER) END AS quantity
FROM lineitem""")
def text_numbers_to_int(spark, sf_dir) -> DataFrame:
    text = F.when(F.col("l_linenumber") % 3 == 0, F.lit("NaN")).otherwise(F.col("l_quantity").cast("double").cast("string"))
    return D.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", X.safe_cast(text, "int", via_double=True).alias("quantity"))


@query("m4_stg_green_sample", covers="FLT-9", sql=warehouse.STG_GREEN_SQL + f"""
SELECT * FROM stg_green WHERE pickup_datetime >= TIMESTAMP '{SAMPLE[0]}' AND pickup_datetime < TIMESTAMP '{SAMPLE[1]}'""")
def m4_stg_green_sample(spark, sf_dir) -> DataFrame:
    return warehouse.stg_green(spark, sf_dir, sample_window=SAMPLE)
