"""Tables survive failed writes, merges read only what they touch, names switch in one step."""
import os
import re

import pytest
from pyspark.sql import functions as F

from meterstar.operators import load
from meterstar.session import delete_path
from meterstar.sources import nested as N

T = "k int, day string, v string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def data(spark, *rs):
    return spark.createDataFrame(list(rs), T)


def broken(spark):
    """Some tasks write their files before one fails."""
    bad = F.when(F.col("id") == 990, F.raise_error(F.lit("broken"))).otherwise(F.lit("x"))
    return spark.range(1000).repartition(7).select(F.col("id").cast("int").alias("k"), F.lit("d1").alias("day"), bad.cast("string").alias("v"))


@pytest.fixture(params=["folder", "parted folder", "name", "parted name"])
def table(request, spark, tmp_dir):
    by = "day" if "parted" in request.param else None
    if "name" in request.param:
        t = load.CatalogTable(spark, f"t_{abs(hash(tmp_dir))}", tmp_dir, by)
    else:
        t = load.TableFolder(spark, os.path.join(tmp_dir, "t"), by)
    load.materialize(spark, data(spark, (1, "d1", "a"), (2, "d2", "b"), (3, None, "c")), "table", t)
    return t


@pytest.mark.parametrize("strategy", ["table", "merge", "append", "delete_insert", "insert_new"])
def test_old_rows_stay_readable_after_a_failed_write(spark, table, strategy):
    before = rows(table.read())
    with pytest.raises(Exception, match="broken"):
        load.materialize(spark, broken(spark), strategy, table, key=["k"])
    assert rows(table.read()) == before
    load.materialize(spark, data(spark, (2, "d2", "B")), "merge", table, key=["k"])     # and the table still works
    assert rows(table.read()) == [(1, "d1", "a"), (2, "d2", "B"), (3, None, "c")]


def test_a_replacement_may_read_its_own_table(spark, table):
    for _ in range(3):
        table.replace(table.read().withColumn("v", F.concat("v", F.lit("!"))))
    assert rows(table.read()) == [(1, "d1", "a!!!"), (2, "d2", "b!!!"), (3, None, "c!!!")]
    assert not [p for p in os.listdir(os.path.dirname(table.path)) if p.endswith(("__next", "__old"))]


def test_new_columns_are_added_and_types_are_kept(spark, table):
    wide = data(spark, (2, "d2", "B"), (9, "d9", "n")).withColumn("extra", F.lit(7))
    load.materialize(spark, wide, "merge", table, key=["k"])
    load.materialize(spark, data(spark, (8, "d1", "z")), "append", table)
    assert rows(table.read().select("k", "v", "extra")) == [(1, "a", None), (2, "B", 7), (3, "c", None), (8, "z", None), (9, "n", 7)]
    with pytest.raises(ValueError, match="column v is string"):
        load.materialize(spark, wide.withColumn("v", F.lit(1)), "append", table)


def test_a_rebuild_may_change_columns(spark, table):
    load.materialize(spark, spark.createDataFrame([(1.5, "d1")], "k double, day string"), "table", table)
    assert table.read().dtypes == [("k", "double"), ("day", "string")] and rows(table.read()) == [(1.5, "d1")]


def test_a_broken_off_switch_is_read_and_mended(spark, tmp_dir):
    t = load.TableFolder(spark, os.path.join(tmp_dir, "t"))
    t.replace(data(spark, (1, "d1", "a")))
    t.prepare(data(spark, (2, "d1", "b")))
    os.rename(t.path, t._old)                                   # the writer stopped between its two renames
    assert rows(load.TableFolder(spark, t.path).read()) == [(1, "d1", "a")]
    t.append(data(spark, (3, "d1", "c")))
    assert rows(t.read()) == [(1, "d1", "a"), (3, "d1", "c")]


def test_names_switch_by_location_and_old_versions_go(spark, tmp_dir):
    t = load.CatalogTable(spark, f"v_{abs(hash(tmp_dir))}", tmp_dir, "day")
    seen = []
    for i in range(4):
        t.replace(data(spark, (i, f"d{i}", "x")))
        seen.append(t.location())
        assert rows(spark.table(t.name).select("k", "_part")) == [(i, f"d{i}")]
    assert len(set(seen)) == 4
    assert sorted(os.listdir(t.path)) == sorted(os.path.basename(p) for p in seen[-2:])   # one version back is kept


def target_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"PartitionFilters: (\[[^\]]*\])", plan)


def test_folders_are_a_static_partition_filter(spark, tmp_dir):
    t = load.TableFolder(spark, os.path.join(tmp_dir, "t"), "day")
    t.replace(data(spark, *[(i, f"d{i % 10}", "a") for i in range(100)], (200, None, "n")))
    found = target_filters(t.touched(["d3", "d4"]))
    assert found and "d3" in found[0] and "d4" in found[0] and "d5" not in found[0]
    assert len(t.touched(["d3"]).inputFiles()) and t.touched(["d3"]).count() == 10 and t.touched([None, "d1"]).count() == 11
    assert t.touched([]).count() == 0
    wanted = spark.createDataFrame([("d1",), (None,)], "_part string")
    assert t.touched(wanted).count() == 11                       # more names than a plan lists: joined


@pytest.mark.parametrize("kind", [load.TableFolder, load.CatalogTable])
def test_merges_read_only_the_folders_of_the_delivery(spark, tmp_dir, monkeypatch, kind):
    t = kind(spark, os.path.join(tmp_dir, "t") if kind is load.TableFolder else f"m_{abs(hash(tmp_dir))}", *(
        [] if kind is load.TableFolder else [tmp_dir]), partition_by="day")
    t.replace(data(spark, *[(i, f"d{i % 10}", "a") for i in range(100)]))
    real, scans = load.TableFolder.touched, []
    monkeypatch.setattr(load.TableFolder, "touched", lambda self, parts: (scans.append(real(self, parts)), scans[-1])[1])
    # files of other folders are gone: a load that looked at them would fail
    for d in range(2, 10):
        delete_path(spark, f"{t.location()}/_part=d{d}")
    load.materialize(spark, data(spark, (1, "d1", "new"), (500, "d1", "new")), "merge", t, key=["k"], moves=False)
    assert "d1" in target_filters(scans[0])[0]
    assert rows(t.read().where("v = 'new'").select("k")) == [(1,), (500,)] and t.read().count() == 21


def test_a_window_is_a_range_of_folders(spark, tmp_dir):
    t = load.TableFolder(spark, os.path.join(tmp_dir, "t"), "day")
    base = spark.sql("SELECT id AS k, TIMESTAMP_NTZ '2024-01-01 06:00:00' + make_dt_interval(id) AS ts FROM range(60)")
    base = base.unionByName(spark.sql("SELECT 99L AS k, CAST(NULL AS TIMESTAMP_NTZ) AS ts"))
    placed = base.withColumn("day", F.to_date("ts"))
    t.replace(placed)
    plan = target_filters(t.scan().where(load.folder_range("2024-01-10", "2024-01-12 12:00:00", "day")))
    assert "2024-01-10" in plan[0] and "2024-01-12" in plan[0]
    kept = {d: set(os.listdir(f"{t.path}/_part={d}")) for d in ("2024-01-09", "2024-01-13")}
    # 10 and 11 January have rows in the re-run, the 12th before noon loses its row, its folder goes
    again = placed.where("day IN (DATE '2024-01-10', DATE '2024-01-11', DATE '2024-01-20')").withColumn("k", F.col("k") + 1000)
    load.materialize(spark, again, "time_interval", t, incremental_key="ts", window=("2024-01-10", "2024-01-12 12:00:00"), period="day")
    got = {r.k for r in t.read().collect()}
    assert got == (set(range(60)) - {9, 10, 11}) | {1009, 1010, 99}
    assert {d: set(os.listdir(f"{t.path}/_part={d}")) for d in kept} == kept
    assert not os.path.exists(f"{t.path}/_part=2024-01-12")


def test_months_are_folders_of_a_window_too(spark):
    df = spark.createDataFrame([("2024-01",), ("2024-02",), ("2024-03",), (None,)], "_part string")
    pick = lambda *w: [r[0] for r in rows(df.where(load.folder_range(*w, "month")))]
    assert pick("2024-01-15", "2024-02-01") == ["2024-01"]
    assert pick("2024-01-15", "2024-02-01 00:00:01") == ["2024-01", "2024-02"]
    assert pick(None, "2024-02-10") == ["2024-01", "2024-02"] and pick("2024-03-31", None) == ["2024-03"]


def test_parent_and_children_switch_together(spark, tmp_dir):
    name = f"books_{abs(hash(tmp_dir))}"
    parent = spark.createDataFrame([(1, "x")], "id int, v string")
    child = spark.createDataFrame([(1, "c1"), (1, "c2")], "id int, name string")
    t = N.replace_with_children(spark, tmp_dir, name, parent, {"authors": child}, catalog=True)
    bad = child.withColumn("name", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        N.replace_with_children(spark, tmp_dir, name, parent.limit(0), {"authors": bad}, catalog=True)
    assert spark.table(name).count() == 1 and spark.table(f"{name}__authors").count() == 2
    t = N.replace_with_children(spark, tmp_dir, name, parent.limit(0), {"authors": child.limit(0)}, catalog=True)
    assert {n: x.read().count() for n, x in t.items()} == {name: 0, f"{name}__authors": 0}
