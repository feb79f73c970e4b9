"""Plans over bucketed tables, analysed tables, footers and folder names."""
import re

from pyspark.sql import functions as F

from meterstar.operators import load
from meterstar.plans import layouts, registry
from meterstar.session import scratch_path
from meterstar.sources import catalog, files
from tests.conftest import SF_SMALL

registry.load_all()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def with_conf(spark, conf, run):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return run()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_bucketed_join_has_no_exchange(spark):
    got = with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}, lambda: plan(layouts.bucketed_trips(spark, SF_SMALL)))
    assert "SortMergeJoin" in got and "Exchange" not in got and "Bucketed: true" in got
    one_file = layouts.bucketed_trips(spark, SF_SMALL).inputFiles()
    assert len(one_file) <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_bucketed_aggregate_has_no_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    t = load.write_bucketed(df, layouts._name("agg"), scratch_path(spark, "bucketed", layouts._name("agg")), ["k"], 4)
    got = t.groupBy("k").agg(F.sum("id").alias("s"))
    assert "Exchange" not in plan(got) and {r.k: r.s for r in got.collect()} == {k: sum(range(k, 1000, 50)) for k in range(50)}


def test_runtime_filter_prunes_the_fact_before_its_shuffle(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    got = with_conf(spark, conf, lambda: plan(layouts.day_by_vendor(spark, SF_SMALL)))
    assert "might_contain" in got and "bloom_filter_agg" in got
    assert got.index("might_contain") > got.index("SortMergeJoin")       # below the join, on the fact's scan


def test_statistics_are_known_to_the_planner(spark):
    name = layouts._name("orders")
    t = catalog.external(spark, name, f"{SF_SMALL}/orders.parquet", ["o_orderkey"])
    info = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Statistics'").first().data_type
    assert re.search(rf"\b{t.count()} rows", info)
    assert catalog.external(spark, layouts._name("orders"), f"{SF_SMALL}/orders.parquet").count() == t.count()


def test_counts_and_extremes_come_from_footers(spark):
    for name in ("m3_row_count", "footer_order_keys"):
        got = plan(registry.QUERIES[name](spark, SF_SMALL))
        assert re.search(r"PushedAggregation: \[COUNT\(\*\)", got), got
    dates = spark.range(100).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"), "id")
    path = scratch_path(spark, "footers", layouts._name("t"))
    dates.repartition(3).write.parquet(path)
    top = files.footer_table(spark, path).agg(F.max("day").alias("d"))
    assert "PushedAggregation: [MAX(day)]" in plan(top) and str(top.first().d) == "2024-04-09"
    assert spark.conf.get("spark.sql.sources.useV1SourceList").count("parquet") == 1   # other reads stay as they were


def test_high_water_reads_the_newest_folder_only(spark):
    for period, fmt in load.PERIODS.items():
        t = load.TableFolder(spark, scratch_path(spark, "newest", layouts._name(period)), "part")
        base = spark.sql("SELECT id AS k, TIMESTAMP_NTZ '2024-01-01 06:00:00' + make_dt_interval(id) AS ts FROM range(70)")
        base = base.unionByName(spark.sql("SELECT 99L AS k, CAST(NULL AS TIMESTAMP_NTZ) AS ts"))
        placed = base.withColumn("part", F.date_format("ts", fmt))
        t.replace(placed)
        newest = t.newest()
        assert newest.count() == {"day": 1, "month": 10}[period] and "2024-03" in plan(newest)
        more = placed.withColumn("ts", F.col("ts") + F.expr("INTERVAL 2 DAYS")).withColumn("part", F.date_format("ts", fmt))
        load.materialize(spark, more, "append", t, high_water="ts", period=period)
        assert t.read().count() == 73 and t.read().agg(F.max("ts")).first()[0] == more.agg(F.max("ts")).first()[0]
    flat = load.TableFolder(spark, scratch_path(spark, "newest", layouts._name("flat")))
    flat.replace(base)
    assert flat.newest().count() == 71
