"""Trap tests for the Column helpers."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterstar.functions import expr as X


def one(spark, col, data, schema):
    return spark.createDataFrame(data, schema).select(col.alias("v")).collect()


def test_safe_cast_text_to_int(spark):
    rows = one(spark, X.safe_cast("s", "int"), [("1",), ("1.0",), ("abc",), ("B00013",), (None,)], "s string")
    assert [r.v for r in rows] == [1, None, None, None, None]
    rows = one(spark, X.safe_cast("s", "int", via_double=True), [("1.0",), ("NaN",), ("x",)], "s string")
    assert [r.v for r in rows] == [1, None, None]


def test_money_keeps_scale(spark):
    rows = one(spark, X.money("s"), [("1.555",), ("1.55",)], "s string")
    assert [r.v for r in rows] == [Decimal("1.555"), Decimal("1.550")]
    # a bare decimal cast would have rounded to an integer
    assert spark.sql("select cast(1.55 as decimal) v").first().v == Decimal("2")


def test_minute_boundaries_not_elapsed_minutes(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 0, 0, 59), dt.datetime(2020, 1, 1, 0, 1, 1)),
                                (dt.datetime(2020, 1, 1, 0, 10, 0), dt.datetime(2020, 1, 1, 0, 0, 30))],
                               "a timestamp_ntz, b timestamp_ntz")
    rows = df.select(X.minute_boundaries("a", "b").alias("m"),
                     F.expr("timestampdiff(MINUTE, a, b)").alias("spark_m")).collect()
    assert [r.m for r in rows] == [1, -10]
    assert rows[0].spark_m == 0


def test_surrogate_key_null_marker(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    keys = [r.k for r in df.select(X.surrogate_key(["x", "y"]).alias("k")).collect()]
    assert keys[0] != keys[1]
    naive = [r.k for r in df.select(F.md5(F.concat_ws("-", "x", "y")).alias("k")).collect()]
    assert naive[0] == naive[1]   # the trap the marker avoids


def test_row_hash_separator(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3")], "a string, b string")
    raw = [r.h for r in df.select(X.row_hash(["a", "b"], sep="").alias("h")).collect()]
    sep = [r.h for r in df.select(X.row_hash(["a", "b"], sep="-").alias("h")).collect()]
    assert raw[0] == raw[1] and sep[0] != sep[1]
    assert isinstance(raw[0], (bytes, bytearray)) and len(raw[0]) == 16


def test_vendor_name_has_no_default(spark):
    rows = one(spark, X.vendor_name("v"), [(1,), (2,), (3,), (4,)], "v int")
    assert [r.v for r in rows] == ["Creative Mobile Technologies", "VeriFone Inc.", None, "Unknown/Other"]


def test_month_start_is_date(spark):
    rows = one(spark, X.month_start("t"), [(dt.datetime(2020, 3, 17, 5, 0),)], "t timestamp_ntz")
    assert rows[0].v == dt.date(2020, 3, 1)


def test_hours_between(spark):
    rows = one(spark, X.hours_between("a", "b"), [(dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1, 1, 30))],
               "a timestamp_ntz, b timestamp_ntz")
    assert rows[0].v == 1.5


def test_parse_ts_lenient_and_strict(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:05",), ("garbage",)], "s string")
    assert [r.v for r in df.select(X.parse_ts("s").alias("v")).collect()][1] is None
    with pytest.raises(Exception):
        df.select(X.parse_ts("s", strict=True).alias("v")).collect()


def test_day_range_is_half_open_on_raw_column(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 31, 23, 59),), (dt.datetime(2020, 2, 1, 0, 0),)],
                               "t timestamp_ntz")
    assert df.where(X.day_range("t", "2020-01-01", "2020-01-31")).count() == 1
    assert df.where(X.on_day("t", "2020-02-01")).count() == 1


def test_mean_matches_sum_over_count(spark):
    df = spark.createDataFrame([(Decimal("1.001"),), (Decimal("1.002"),), (None,)], "x decimal(18,3)")
    assert df.agg(X.mean("x").alias("m")).first().m == 2.003 / 2


def test_format_round_and_rank_helpers(spark):
    from meterstar.operators import dedup
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5), "1.2345", "a", 3),
                                (dt.datetime(2024, 1, 2, 3, 4, 6), "2.0", "a", 1),
                                (dt.datetime(2024, 1, 2, 3, 4, 7), "0.5", "b", 1)], "t timestamp_ntz, s string, g string, n int")
    r = df.select(X.format_ts("t").alias("f"), X.round_money("s", 2).alias("r")).first()
    assert r.f == "2024-01-02 03:04:05" and r.r == Decimal("1.23")
    ranked = {(x.g, x.n): x.rnk for x in dedup.rank_dense(df, ["g"], ["n"]).collect()}
    assert ranked == {("a", 1): 1, ("a", 3): 2, ("b", 1): 1}
    with pytest.raises(ValueError):
        dedup.rank_dense(df, [], ["n"])
    assert dedup.highest_with_ties(df, "n").count() == 1


def test_scale_settings():
    from meterstar.session import scale_settings
    s = scale_settings(100 * 1024 ** 4, 8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 409600
    assert scale_settings(10, 8)["spark.sql.shuffle.partitions"] == "16"
