"""Landing reads (CSV header check, monthly file expansion) and partitioned layouts."""
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterstar.operators import load
from meterstar.sources import driver_tables as D
from meterstar.sources import files
from tests.conftest import SF_SMALL


def test_monthly_file_names_keep_month_starts_only():
    assert files.monthly_file_names("2019-01-15", "2019-03-01", ["green", "yellow"]) == [
        "green_tripdata_2019-02.parquet", "yellow_tripdata_2019-02.parquet",
        "green_tripdata_2019-03.parquet", "yellow_tripdata_2019-03.parquet"]


def test_read_monthly_feeds_tags_and_unions(spark, tmp_dir):
    spark.createDataFrame([(1, 2.0)], "a int, b double").write.parquet(f"{tmp_dir}/green_tripdata_2020-01.parquet")
    spark.createDataFrame([(3,)], "a int").write.parquet(f"{tmp_dir}/yellow_tripdata_2020-01.parquet")
    df = files.read_monthly_feeds(spark, tmp_dir, "2020-01-01", "2020-01-31", ["green", "yellow"])
    assert sorted((r.a, r.b, r.taxi_type) for r in df.collect()) == [(1, 2.0, "green"), (3, None, "yellow")]


def test_csv_declared_schema_header_check(spark, tmp_dir):
    path = os.path.join(tmp_dir, "z.csv")
    with open(path, "w") as f:
        f.write("LocationID,Borough,Zone,extra\n1,EWR,Newark Airport,x\n2,Queens,Jamaica Bay\n")
    good = T.StructType([T.StructField("LocationID", T.IntegerType()), T.StructField("Borough", T.StringType()),
                         T.StructField("Zone", T.StringType())])
    rows = files.read_csv(spark, path, good).collect()
    assert [(r.LocationID, r.Zone) for r in rows] == [(1, "Newark Airport"), (2, "Jamaica Bay")]
    wrong = T.StructType([T.StructField("Zone", T.StringType()), T.StructField("LocationID", T.IntegerType())])
    with pytest.raises(Exception):
        files.read_csv(spark, path, wrong).collect()
    assert files.with_source_file(files.read_csv(spark, path)).first().filename == "z.csv"


def test_partitioned_clustered_write_prunes(spark, tmp_dir):
    t = D.trips(spark, SF_SMALL, ["vendor_id", "pickup_datetime"])
    path = os.path.join(tmp_dir, "trips_part")
    load.write_partitioned(t, path, "pickup_datetime", cluster_by=["vendor_id"])
    part = spark.read.parquet(path)
    q = part.where(load.pruned_range("pickup_datetime", "1996-03-01", "1996-03-16")).select("vendor_id").distinct()
    plain = t.where((F.col("pickup_datetime") >= "1996-03-01") & (F.col("pickup_datetime") < "1996-03-16")) \
        .select("vendor_id").distinct()
    assert sorted(r.vendor_id for r in q.collect()) == sorted(r.vendor_id for r in plain.collect())
    p = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_date" in p
    load.write_files(t, os.path.join(tmp_dir, "four"), 4)
    assert len([f for f in os.listdir(os.path.join(tmp_dir, "four")) if f.endswith(".parquet")]) == 4


def test_gzip_csv_and_catalog_views(spark, tmp_dir):
    import gzip

    from meterstar.sources import catalog
    path = os.path.join(tmp_dir, "payment_type_lookup.csv.gz")
    with gzip.open(path, "wt") as f:
        f.write("payment_type,description\n0,Unknown\n1,Credit card\n")
    schema = T.StructType([T.StructField("payment_type", T.IntegerType()), T.StructField("description", T.StringType())])
    df = files.read_csv(spark, path, schema)
    assert [(r.payment_type, r.description) for r in df.collect()] == [(0, "Unknown"), (1, "Credit card")]
    catalog.view(df, "payment_type_lookup")
    assert catalog.named(spark, "payment_type_lookup").count() == 2
    assert "orders" in catalog.register_views(spark, SF_SMALL) and catalog.named(spark, "orders").count() > 0


def test_development_sample_window(spark):
    from meterstar.plans import warehouse
    full = warehouse.stg_green(spark, SF_SMALL)
    dev = warehouse.stg_green(spark, SF_SMALL, sample_window=("1996-01-01", "1996-02-01"))
    expect = full.where((F.col("pickup_datetime") >= "1996-01-01") & (F.col("pickup_datetime") < "1996-02-01"))
    assert dev.count() == expect.count() > 0


def test_preview_is_bounded(spark):
    from meterstar.sources import catalog
    pdf = catalog.preview(D.trips(spark, SF_SMALL, ["vendor_id", "fare_amount"]), 5)
    assert len(pdf) == 5 and list(pdf.columns) == ["vendor_id", "fare_amount"]


def test_read_seed_enforces_primary_key(spark, tmp_dir):
    from meterstar.operators.quality import QualityError
    schema = T.StructType([T.StructField("payment_type", T.IntegerType()), T.StructField("description", T.StringType())])
    good = os.path.join(tmp_dir, "good.csv")
    bad = os.path.join(tmp_dir, "bad.csv")
    with open(good, "w") as f:
        f.write("payment_type,description\n0,Unknown\n1,Credit card\n5,Unknown\n")
    with open(bad, "w") as f:
        f.write("payment_type,description\n1,Credit card\n1,Cash\n")
    assert files.read_seed(spark, good, schema, ["payment_type"]).count() == 3
    with pytest.raises(QualityError):
        files.read_seed(spark, bad, schema, ["payment_type"])


def test_every_csv_file_is_checked_against_the_schema(spark, tmp_dir):
    d = os.path.join(tmp_dir, "two")
    os.makedirs(d)
    for name, text in (("a.csv", "x,y\n1,2\n"), ("b.csv", "y,x\n10,20\n")):
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    schema = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.IntegerType())])
    with pytest.raises(Exception):
        files.read_csv(spark, d, schema).collect()


def test_months_with_other_columns_are_merged(spark, tmp_dir):
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{tmp_dir}/green_tripdata_2020-01.parquet")
    spark.createDataFrame([(2, "x")], "a int, extra string").write.parquet(f"{tmp_dir}/green_tripdata_2020-02.parquet")
    df = files.read_monthly_feeds(spark, tmp_dir, "2020-01-01", "2020-02-28", ["green"])
    assert sorted((r.a, r.extra) for r in df.collect()) == [(1, None), (2, "x")]


def test_shared_folder_is_asked_for_off_local_masters():
    from meterstar import session

    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())
    Session.conf["spark.checkpoint.dir"] = "hdfs:///shared"
    assert session.checkpoint_root(Session()) == "hdfs:///shared"
