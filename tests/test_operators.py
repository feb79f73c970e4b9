"""Dedup / ranking / enrichment / load strategies on inline frames."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from meterstar.operators import dedup, load, star


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_nulls_first)


def _nulls_first(t):
    return tuple((v is not None, v) for v in t)


def test_keep_first_uses_total_order(spark):
    df = spark.createDataFrame([(1, 10, "b"), (1, 10, "a"), (2, 5, "z"), (1, 9, "c")], "k int, o int, t string")
    assert rows(dedup.keep_first(df, ["k"], ["o", "t"]), "k", "o", "t") == [(1, 9, "c"), (2, 5, "z")]
    with pytest.raises(ValueError):
        dedup.keep_first(df, ["k"], [])


def test_keep_first_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    plan = dedup.keep_first(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2   # partial (map side) + final


def test_lowest_with_ties_and_top_n(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "z string, n int")
    assert rows(dedup.lowest_with_ties(df, "n"), "z") == [("a",), ("b",)]
    assert dedup.top_n(df, [F.col("n").desc(), "z"], 1).first().z == "c"


def test_enrich_role_playing_and_orphans(spark):
    fact = spark.createDataFrame([(1, 2), (2, 9)], "pu int, do int")
    dim = spark.createDataFrame([(1, "A"), (2, "B")], "id int, zone string")
    out = star.role_playing(fact, dim, "id", {"p": "pu", "d": "do"}, ["zone"])
    assert rows(out, "pu", "p_zone", "d_zone") == [(1, "A", "B"), (2, "B", None)]
    assert star.orphans(fact, dim, "do", "id").count() == 1


T = "k int, v string"


def test_insert_new_keeps_source_duplicates_and_null_keys(spark):
    t = spark.createDataFrame([(1, "t1")], T)
    s = spark.createDataFrame([(1, "s1"), (2, "s2"), (2, "s2b"), (None, "sn")], T)
    out = load.insert_new(t, s, ["k"])
    assert rows(out, "k", "v") == [(None, "sn"), (1, "t1"), (2, "s2"), (2, "s2b")]


def test_upsert_vs_delete_insert(spark):
    t = spark.createDataFrame([(1, "old"), (3, "keep")], T)
    s = spark.createDataFrame([(1, "a"), (1, "b")], T)
    up = rows(load.upsert(t, s, ["k"], order=["v"]), "k", "v")
    di = rows(load.delete_insert(t, s, ["k"]), "k", "v")
    assert up == [(1, "a"), (3, "keep")]
    assert di == [(1, "a"), (1, "b"), (3, "keep")]


def test_replace_interval_empties_day_without_new_rows(spark):
    d = lambda day: dt.datetime(2020, 1, day)
    t = spark.createDataFrame([(d(1), 1), (d(2), 2), (d(3), 3)], "ts timestamp_ntz, x int")
    s = spark.createDataFrame([(d(1), 10)], "ts timestamp_ntz, x int")
    out = load.replace_interval(t, s, "ts", "2020-01-01", "2020-01-03")
    assert rows(out, "x") == [(3,), (10,)]


def test_high_water(spark):
    d = lambda h: dt.datetime(2020, 1, 1, h)
    src = spark.createDataFrame([(d(1),), (d(2),), (d(3),)], "ts timestamp_ntz")
    tgt = spark.createDataFrame([(d(2),)], "ts timestamp_ntz")
    assert rows(load.high_water_rows(src, tgt, "ts"), "ts") == [(d(3),)]          # tie with max skipped
    assert rows(load.high_water_rows(src, tgt, "ts", lookback="1 hour"), "ts") == [(d(2),), (d(3),)]
    assert load.high_water_rows(src, None, "ts").count() == 3
    empty = spark.createDataFrame([], "ts timestamp_ntz")
    assert load.high_water_rows(src, empty, "ts").count() == 3


def test_add_new_columns(spark):
    t = spark.createDataFrame([(1,)], "a int")
    s = spark.createDataFrame([(2, "x")], "a int, b string")
    out = load.add_new_columns(t, s)
    assert out.columns == ["a", "b"]
    assert rows(out, "a", "b") == [(1, None), (2, "x")]


def test_materialize_strategies_and_idempotence(spark, tmp_dir):
    tbl = load.TableFolder(spark, f"{tmp_dir}/t")
    assert tbl.read() is None
    a = spark.createDataFrame([(1, "a"), (2, "b")], T)
    load.materialize(spark, a, "table", tbl)
    b = spark.createDataFrame([(2, "B"), (3, "c")], T)
    load.materialize(spark, b, "insert_new", tbl, key=["k"])
    assert rows(tbl.read(), "k", "v") == [(1, "a"), (2, "b"), (3, "c")]
    load.materialize(spark, b, "insert_new", tbl, key=["k"])     # second run changes nothing
    assert tbl.read().count() == 3
    load.materialize(spark, b, "merge", tbl, key=["k"])
    load.materialize(spark, b, "merge", tbl, key=["k"])
    assert rows(tbl.read(), "k", "v") == [(1, "a"), (2, "B"), (3, "c")]
    wide = spark.createDataFrame([(4, "d", 1.0)], "k int, v string, extra double")
    load.materialize(spark, wide, "merge", tbl, key=["k"])
    got = tbl.read()
    assert "extra" in got.columns and got.count() == 4
    load.materialize(spark, a, "append", tbl)
    assert tbl.read().count() == 6
    load.materialize(spark, a, "merge", tbl, key=["k"], full_refresh=True)
    assert tbl.read().count() == 2
    with pytest.raises(ValueError):
        load.materialize(spark, a, "bogus", tbl)


def test_interval_keeps_to_its_window_from_the_first_run_on(spark, tmp_dir):
    tbl = load.TableFolder(spark, f"{tmp_dir}/ti")
    d = lambda day: dt.datetime(2020, 1, day)
    schema = "ts timestamp_ntz, x int"
    run = lambda data, window: load.materialize(
        spark, spark.createDataFrame(data, schema), "time_interval", tbl, incremental_key="ts", window=window)
    run([(d(1), 1), (d(2), 2), (d(9), 9)], ("2020-01-01", "2020-01-06"))      # day 9 lies outside
    assert rows(tbl.read(), "x") == [(1,), (2,)]
    run([(d(5), 5)], ("2020-01-05", "2020-01-06"))
    for _ in range(2):   # idempotent
        run([(d(1), 11)], ("2020-01-01", "2020-01-04"))
    assert rows(tbl.read(), "x") == [(5,), (11,)]


def files_under(path, folder):
    base = f"{path}/{folder}"
    return {f for f in os.listdir(base) if f.endswith(".parquet")} if os.path.isdir(base) else set()


def test_partitioned_table_rewrites_only_touched_partitions(spark, tmp_dir):
    d = lambda day, h=0: dt.datetime(2020, 1, day, h)
    schema = "k int, ts timestamp_ntz, v string"
    path = f"{tmp_dir}/pt"
    tbl = load.TableFolder(spark, path, partition_by="day")
    day = lambda df: df.withColumn("day", F.to_date("ts"))
    base = spark.createDataFrame([(1, d(1), "a"), (2, d(2), "b"), (3, d(3), "c"), (4, d(3, 5), "d")], schema)
    load.materialize(spark, day(base), "table", tbl)
    third = files_under(path, "_part=2020-01-03")
    # key 2 moves from day 2 to day 4; key 1 changes in place; day 3 untouched
    src = day(spark.createDataFrame([(2, d(4), "B"), (1, d(1, 3), "A")], schema))
    load.materialize(spark, src, "merge", tbl, key=["k"])
    assert rows(tbl.read(), "k", "v") == [(1, "A"), (2, "B"), (3, "c"), (4, "d")]
    assert files_under(path, "_part=2020-01-03") == third and not files_under(path, "_part=2020-01-02")
    # interval replace on a partitioned table: window empties day 3 except rows outside it
    run = day(spark.createDataFrame([(9, d(3, 1), "z")], schema))
    for _ in range(2):
        load.materialize(spark, run, "time_interval", tbl, incremental_key="ts",
                         window=("2020-01-03 00:00:00", "2020-01-03 04:00:00"))
    assert rows(tbl.read(), "k", "v") == [(1, "A"), (2, "B"), (4, "d"), (9, "z")]


def test_null_and_text_partitions_survive_a_merge(spark, tmp_dir):
    tbl = load.TableFolder(spark, f"{tmp_dir}/np", partition_by="p")
    schema = "k int, p string, v string"
    load.materialize(spark, spark.createDataFrame([(1, None, "null"), (2, "01", "x"), (3, "1", "y"), (4, "", "empty"), (5, "a/b=c", "odd")], schema), "table", tbl)
    load.materialize(spark, spark.createDataFrame([(2, "01", "X")], schema), "merge", tbl, key=["k"])
    want = [(1, None, "null"), (2, "01", "X"), (3, "1", "y"), (4, "", "empty"), (5, "a/b=c", "odd")]
    assert rows(tbl.read(), "k", "p", "v") == want
    load.materialize(spark, spark.createDataFrame([(1, None, "NULL"), (5, None, "moved")], schema), "merge", tbl, key=["k"])
    assert rows(tbl.read(), "k", "p", "v") == [(1, None, "NULL"), *want[1:4], (5, None, "moved")]


def test_a_read_error_is_no_empty_table(spark, tmp_dir):
    path = f"{tmp_dir}/err"
    tbl = load.TableFolder(spark, path)
    load.materialize(spark, spark.createDataFrame([(i, "v") for i in range(5)], T), "table", tbl)
    kept = {f: open(f"{path}/{f}", "rb").read() for f in os.listdir(path) if f.endswith(".parquet")}
    for f in kept:
        with open(f"{path}/{f}", "wb") as out:
            out.write(b"not parquet")
    with pytest.raises(Exception):
        load.materialize(spark, spark.createDataFrame([(9, "new")], T), "merge", tbl, key=["k"])
    assert {f for f in os.listdir(path) if f.endswith(".parquet")} == set(kept)


def test_high_water_merge_through_materialize(spark, tmp_dir):
    d = lambda h: dt.datetime(2020, 1, 1, h)
    schema = "k int, ts timestamp_ntz, v string"
    tbl = load.TableFolder(spark, f"{tmp_dir}/hw")
    load.materialize(spark, spark.createDataFrame([(1, d(1), "a"), (2, d(2), "b")], schema), "merge", tbl, key=["k"])
    feed = spark.createDataFrame([(1, d(1), "CHANGED-OLD"), (2, d(2), "TIE"), (3, d(3), "c")], schema)
    load.materialize(spark, feed, "merge", tbl, key=["k"], high_water="ts")
    assert rows(tbl.read(), "k", "v") == [(1, "a"), (2, "b"), (3, "c")]      # strict '>' skips the tie
    # the table's maximum is now 03:00; a 2-hour lookback re-takes rows after 01:00, so the 02:00 row
    # replaces its key while the 01:00 row stays out
    load.materialize(spark, feed, "merge", tbl, key=["k"], high_water="ts", lookback="2 hours")
    assert rows(tbl.read(), "k", "v") == [(1, "a"), (2, "TIE"), (3, "c")]


def test_failed_load_leaves_the_table_as_it_was(spark, tmp_dir):
    for part in (None, "k"):
        tbl = load.TableFolder(spark, f"{tmp_dir}/atomic-{part}", partition_by=part)
        load.materialize(spark, spark.createDataFrame([(1, "a"), (2, "b")], T), "table", tbl)
        # a source whose evaluation fails part-way through the write
        bad = spark.createDataFrame([(2, "B"), (3, "boom")], T).withColumn(
            "v", F.when(F.col("v") == "boom", F.raise_error(F.lit("simulated task failure"))).otherwise(F.col("v")))
        for strategy in ("merge", "append", "insert_new"):
            with pytest.raises(Exception):
                load.materialize(spark, bad, strategy, tbl, key=["k"])
        assert rows(tbl.read(), "k", "v") == [(1, "a"), (2, "b")]


def test_no_job_runs_while_a_plan_is_built(spark):
    from meterstar.sources import driver_tables as D
    from tests.conftest import SF_SMALL
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "")
    t = D.trips(spark, SF_SMALL)
    star.role_playing(t, D.zones(spark, SF_SMALL), "location_id", {"p": "pickup_location_id"}, ["zone"])
    load.upsert(t, t, ["l_orderkey"] if "l_orderkey" in t.columns else ["vendor_id"], order=["pickup_datetime"])
    star.orphans(t, D.zones(spark, SF_SMALL), "pickup_location_id", "location_id")
    jobs = tracker.getJobIdsForGroup("plan-only")
    # reading a Parquet footer for its schema is the only kind of job: one per table, none that counts rows
    assert len(jobs) <= 12
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
