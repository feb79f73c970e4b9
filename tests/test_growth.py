"""Plans and runs whose time or memory must not grow faster than the tables."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from meterstar.plans import registry
from meterstar.plans import stream_jobs as J
from meterstar.streaming import jobs as S

registry.load_all()


def _tables(spark, at, lines, orders):
    """lineitem of (order, line) and orders of (order, date), in the driver's columns."""
    li = spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int").select(
        "l_orderkey", F.lit(1).cast("bigint").alias("l_partkey"), F.lit(2).cast("bigint").alias("l_suppkey"), "l_linenumber",
        *[F.lit(10.0).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), F.lit(dt.datetime(1999, 1, 1)).cast("timestamp_ntz").alias("l_shipdate"))
    li.write.parquet(os.path.join(at, "lineitem.parquet"))
    o = spark.createDataFrame(orders, "o_orderkey bigint, at string").select(
        "o_orderkey", F.lit(1).cast("bigint").alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit(5.0).alias("o_totalprice"),
        F.col("at").cast("timestamp_ntz").alias("o_orderdate"), F.lit("2-HIGH").alias("o_orderpriority"))
    o.write.parquet(os.path.join(at, "orders.parquet"))


def test_high_water_append_sorts_no_trips(spark, tmp_dir):
    old, mark, new = "1998-03-01 00:00:00", "1998-12-31 00:00:00", "1999-02-01 00:00:00"
    _tables(spark, tmp_dir, [(1, 1), (1, 2), (2, 1), (3, 1), (4, 1), (5, 1), (None, 1), (9, 1)],
            [(1, old), (2, mark), (3, new), (4, None), (5, old), (5, new), (None, new)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as at a size where no side can be broadcast
    try:
        df = registry.QUERIES["snk_high_water_append"](spark, tmp_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.l_orderkey, r.l_linenumber, str(r.pickup_datetime)) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == [(1, 1, old), (1, 2, old), (2, 1, mark), (3, 1, new), (5, 1, old), (5, 1, new)]
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def _counted(spark):
    """A column function that passes text on and counts the rows it has seen."""
    seen = spark.sparkContext.accumulator(0)

    def see(x):
        seen.add(1)
        return x
    return seen, F.udf(see, "string").asNondeterministic()


def test_state_partitions_follow_the_topic(spark, tmp_dir, monkeypatch):
    rows = [(i, f"2024-01-{1 + i // 100:02d} {i % 24:02d}:{i % 60:02d}:07.5", i % 7, 1.5) for i in range(400)]
    events = spark.createDataFrame([*rows, (400, None, 1, 1.0), (401, "2024-01-02 00:00:00", None, None)],
                                   "event_id bigint, at string, user_id bigint, value double")
    events.select("event_id", F.col("at").cast("timestamp_ntz").alias("ts"), "user_id", F.lit("x").alias("event_type"), "value",
                  F.lit("{}").alias("props")).write.parquet(os.path.join(tmp_dir, "events.parquet"))
    runs = []
    real = S.run_bounded
    monkeypatch.setattr(S, "run_bounded", lambda *a, **k: (runs.append(real(*a, **k)), runs[-1])[1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        got = sorted(map(tuple, registry.QUERIES["stream_zone_sessions"](spark, tmp_dir).collect()))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "16"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == sorted(map(tuple, J.zone_sessions(J.decoded(spark, tmp_dir)).collect())) and len(got) > 100
    ops = [p["stateOperators"][0] for p in runs[-1].recentProgress if p["stateOperators"]]
    assert {o["numShufflePartitions"] for o in ops} == {spark.sparkContext.defaultParallelism}   # 16 before
    assert all(o["numRowsDroppedByWatermark"] == 0 for o in ops)
    assert S.state_parts(spark, 100 << 30) == 1600


def test_the_batch_that_begins_a_table_runs_once(spark, tmp_dir):
    seen, see = _counted(spark)
    table = S.load.TableFolder(spark, os.path.join(tmp_dir, "table"), "day")
    S.upsert_sink(table, ["k"], derive={"day": F.col("v")})(spark.range(500).select(F.col("id").alias("k"), see(F.lit("d")).alias("v")), 0)
    assert table.read().count() == 500 and seen.value == 500


@pytest.mark.parametrize("files", [1, 4])
def test_messages_are_made_once(spark, tmp_dir, files):
    seen, see = _counted(spark)
    topic = os.path.join(tmp_dir, "topic")
    S.publish_in_order(spark.range(1000).withColumnRenamed("id", "at"), "at", topic, files, value=see(F.col("at").cast("string")))
    assert S.read_topic_batch(spark, "", path=topic).distinct().count() == 1000 and seen.value == 1000
    assert S.folder_bytes(spark, topic) >= sum(os.path.getsize(f"{topic}/{f}") for f in os.listdir(topic) if f.startswith("part-"))
