"""Stream = batch equivalence (bounded availableNow runs on a file stream), JSON modes, gaps, skew."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from meterstar.operators import load
from meterstar.plans import stream_jobs as J
from meterstar.streaming import jobs as S
from meterstar.streaming import windows as W
from tests.conftest import SF_SMALL


def as_set(df, cols):
    return {tuple(r[c] for c in cols) for r in df.collect()}


@pytest.fixture(scope="module")
def topic_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("topic") / "green-trips")
    J.trip_topic(spark, SF_SMALL).repartition(3).write.json(path)
    return path


def test_stream_five_minute_counts_equal_batch(spark, topic_dir, tmp_dir):
    stream = W.parse_trip_events(S.read_topic(spark, "green-trips", path=topic_dir))
    table = load.TableFolder(spark, os.path.join(tmp_dir, "counts"))
    S.run_bounded(J.five_minute_counts(stream), os.path.join(tmp_dir, "ck1"), "update",
                  sink=S.upsert_sink(table, ["window_start", "pulocationid"]))
    batch = J.five_minute_counts(J.decoded(spark, SF_SMALL))
    cols = ["window_start", "pulocationid", "num_trips"]
    assert as_set(table.read(), cols) == as_set(batch, cols)


def test_stream_counts_into_partitioned_table(spark, tmp_dir):
    # the topic arrives in time order, one file per micro-batch (lateness is judged per batch)
    import time as _time
    topic = os.path.join(tmp_dir, "ordered-topic")
    msgs = J.trip_events_frame(spark, SF_SMALL)
    cuts = ["2024-01-11 00:00:00", "2024-01-21 00:00:00"]
    t = F.col("lpep_pickup_datetime")
    for cond in (t < cuts[0], (t >= cuts[0]) & (t < cuts[1]), t >= cuts[1]):
        W.to_messages(msgs.where(cond), W.TRIP_EVENT_FIELDS).coalesce(1).write.mode("append").json(topic)
        _time.sleep(1.1)
    stream = W.parse_trip_events(S.read_topic(spark, "green-trips", path=topic, max_per_trigger=1))
    table = load.TableFolder(spark, os.path.join(tmp_dir, "counts_by_day"), partition_by="window_day")
    S.run_bounded(J.five_minute_counts(stream), os.path.join(tmp_dir, "ckp"), "update",
                  sink=S.upsert_sink(table, ["window_start", "pulocationid"],
                                     derive={"window_day": F.to_date("window_start")}))
    batch = J.five_minute_counts(J.decoded(spark, SF_SMALL))
    cols = ["window_start", "pulocationid", "num_trips"]
    assert as_set(table.read(), cols) == as_set(batch, cols)


def test_unbounded_query_runs_and_stops(spark, topic_dir, tmp_dir):
    stream = W.parse_trip_events(S.read_topic(spark, "green-trips", path=topic_dir))
    out = os.path.join(tmp_dir, "pass")
    q = S.run_unbounded(W.pass_through(stream), os.path.join(tmp_dir, "cku"), "append", every="1 second", path=out)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(out).count() == J.decoded(spark, SF_SMALL).count()


def test_stream_hourly_tips_equal_batch(spark, topic_dir, tmp_dir):
    stream = W.parse_trip_events(S.read_topic(spark, "green-trips", path=topic_dir))
    table = load.TableFolder(spark, os.path.join(tmp_dir, "tips"))
    S.run_bounded(J.hourly_tips(stream), os.path.join(tmp_dir, "ck2"), "update",
                  sink=S.upsert_sink(table, ["window_start", "window_end"]))
    batch = J.hourly_tips(J.decoded(spark, SF_SMALL))
    cols = ["window_start", "window_end", "total_tip_amount"]
    assert as_set(table.read(), cols) == as_set(batch, cols)


def test_stream_sessions_equal_batch(spark, topic_dir, tmp_dir):
    stream = W.parse_trip_events(S.read_topic(spark, "green-trips", path=topic_dir))
    table = load.TableFolder(spark, os.path.join(tmp_dir, "sessions"))
    S.run_bounded(J.zone_sessions(stream), os.path.join(tmp_dir, "ck3"), "complete", sink=S.replace_sink(table))
    batch = J.zone_sessions(J.decoded(spark, SF_SMALL))
    cols = ["window_start", "window_end", "pulocationid", "num_trips"]
    assert as_set(table.read(), cols) == as_set(batch, cols)


def test_pass_through_file_sink(spark, topic_dir, tmp_dir):
    stream = W.parse_trip_events(S.read_topic(spark, "green-trips", path=topic_dir), strict=True)
    out = os.path.join(tmp_dir, "processed")
    S.run_bounded(W.pass_through(stream), os.path.join(tmp_dir, "ck4"), "append", path=out)
    assert spark.read.parquet(out).count() == J.decoded(spark, SF_SMALL).count()


def test_json_modes(spark):
    msgs = spark.createDataFrame([('{"PULocationID": 1, "lpep_pickup_datetime": "2024-01-01 00:00:00"}',),
                                  ("{not json",),
                                  ('{"PULocationID": 2, "lpep_pickup_datetime": "bad time"}',)], "value string")
    ok = W.guard(W.parse_trip_events(msgs), "PULocationID", "event_time")
    assert ok.count() == 1
    with pytest.raises(Exception):
        W.parse_trip_events(msgs, strict=True).collect()


def _events(spark, rows):
    return spark.createDataFrame(rows, "PULocationID int, event_time timestamp_ntz")


def test_session_gap_boundary(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    same = _events(spark, [(1, t0), (1, t0 + dt.timedelta(minutes=5))])
    split = _events(spark, [(1, t0), (1, t0 + dt.timedelta(minutes=5, seconds=1))])
    for fn in (W.session_counts, W.session_counts_split):
        assert fn(same, "5 minutes", "PULocationID").count() == 1
        assert fn(split, "5 minutes", "PULocationID").count() == 2
    r = W.session_counts_split(same, "5 minutes", "PULocationID").first()
    assert r.window_end == t0 + dt.timedelta(minutes=10)


def test_split_sessions_match_native_on_hot_key(spark):
    # key 7 holds most events, with sessions crossing many hour edges (events every 4 minutes for
    # 6 hours, then sparse), plus a few other keys
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [(7, t0 + dt.timedelta(minutes=4 * i)) for i in range(90)]
    rows += [(7, t0 + dt.timedelta(hours=8, minutes=11 * i)) for i in range(30)]
    rows += [(k, t0 + dt.timedelta(minutes=3 * i + k)) for k in (1, 2) for i in range(10)]
    ev = _events(spark, rows)
    cols = ["window_start", "window_end", "pulocationid", "num_trips"]
    for gap in ("5 minutes", "30 minutes", "2 hours"):
        assert as_set(W.session_counts_split(ev, gap, "PULocationID"), cols) == \
            as_set(W.session_counts(ev, gap, "PULocationID"), cols)
    g = ["window_start", "window_end", "num_trips"]
    assert as_set(W.session_counts_split(ev, "5 minutes", None), g) == as_set(W.session_counts(ev, "5 minutes", None), g)
    # many buckets, and a burst of identical timestamps on the hot key (split across slices)
    burst = _events(spark, rows + [(7, t0 + dt.timedelta(minutes=40))] * 200)
    for nb in (3, 16, 64):
        assert as_set(W.session_counts_split(burst, "5 minutes", "PULocationID", buckets=nb), cols) == \
            as_set(W.session_counts(burst, "5 minutes", "PULocationID"), cols)
        assert as_set(W.session_counts_split(burst, "30 minutes", None, buckets=nb), g) == \
            as_set(W.session_counts(burst, "30 minutes", None), g)


def test_longest_session_single_row(spark):
    s = spark.createDataFrame([(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1), 3, 5),
                               (dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 1), 4, 5)],
                              "window_start timestamp_ntz, window_end timestamp_ntz, pulocationid int, num_trips long")
    r = W.longest_session(s).collect()
    assert len(r) == 1 and r[0].id == 1 and r[0].pulocationid == 3


def test_bounded_batch_read_of_topic_folder(spark, topic_dir):
    from meterstar.sources import files
    msgs = S.read_topic_batch(spark, "green-trips", path=topic_dir)
    assert msgs.count() == J.trip_topic(spark, SF_SMALL).count()
    assert files.generated_range(spark, 10).count() == 10
    with pytest.raises(ValueError):
        S.read_topic(spark, "green-trips")


def test_consumer_counts_every_record(spark):
    ev = J.decoded(spark, SF_SMALL)
    full = W.count_with_predicate(ev, F.col("trip_distance") > 5, "over").first()
    assert full.record_count == ev.count() and full.over == ev.where("trip_distance > 5").count()


def test_publish_then_consume(spark, tmp_dir):
    topic = os.path.join(tmp_dir, "published")
    S.publish(J.trip_topic(spark, SF_SMALL), "green-trips", path=topic)
    got = W.parse_trip_events(S.read_topic_batch(spark, "green-trips", path=topic))
    cols = ["PULocationID", "event_time", "tip_amount"]
    assert as_set(got, cols) == as_set(J.decoded(spark, SF_SMALL), cols)


def test_append_sessions_emit_closed_sessions_only(spark, tmp_dir):
    """append with a watermark: a closed session leaves the state and is written once."""
    import time as _time
    topic, out = os.path.join(tmp_dir, "session-topic"), os.path.join(tmp_dir, "sessions")
    msgs = J.trip_events_frame(spark, SF_SMALL)
    closing = msgs.limit(1).withColumn("lpep_pickup_datetime", F.lit("2030-01-01 00:00:00")).withColumn("PULocationID", F.lit(-1))
    for part in (msgs, closing, closing):       # the last batch comes after the watermark has moved
        W.to_messages(part, W.TRIP_EVENT_FIELDS).coalesce(1).write.mode("append").json(topic)
        _time.sleep(1.1)
    stream = W.parse_trip_events(S.read_topic(spark, "green-trips", path=topic, max_per_trigger=1))
    S.run_bounded(J.zone_sessions(stream), os.path.join(tmp_dir, "ck"), "append", path=out)
    cols = ["window_start", "window_end", "pulocationid", "num_trips"]
    got = spark.read.parquet(out)
    assert as_set(got, cols) == as_set(J.zone_sessions(J.decoded(spark, SF_SMALL)), cols)
    assert got.count() == got.select("window_start", "pulocationid").distinct().count()


# --- streams that queries run: order of files, restarts, replays ------------------------------------------


def test_files_are_published_in_event_order(spark, tmp_dir):
    topic = os.path.join(tmp_dir, "topic")
    first = spark.range(1000).select(F.to_json(F.struct("id")).alias("value"), (F.col("id") * 7 % 1000).alias("at"))
    S.publish_in_order(first, "at", topic, 5)
    S.publish_in_order(first.withColumn("at", F.col("at") + 1000), "at", topic, 3)
    files = sorted((p for p in os.listdir(topic) if p.startswith("part-")), key=lambda p: os.stat(f"{topic}/{p}").st_mtime_ns)
    at = [[int(r.value[6:-1]) * 7 % 1000 for r in S.read_topic_batch(spark, "", path=f"{topic}/{p}").collect()] for p in files]
    assert len(files) == 8 and sum(map(len, at)) == 2000
    for group in (at[:5], at[5:]):
        assert all(max(a) < min(b) for a, b in zip(group, group[1:]))


def test_sessions_come_in_several_batches_and_leave_the_state(spark, monkeypatch):
    runs = []
    real = S.run_bounded
    monkeypatch.setattr(S, "run_bounded", lambda *a, **k: (runs.append(real(*a, **k)), runs[-1])[1])
    J.sessions_sink(spark, SF_SMALL)
    progress = runs[0].recentProgress
    assert len([p for p in progress if p["numInputRows"]]) >= J.MICRO_BATCHES
    assert all(s["numRowsDroppedByWatermark"] == 0 for p in progress for s in p["stateOperators"])
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] <= 1        # at most the closing event's session is open


def test_a_replayed_batch_changes_nothing(spark, tmp_dir):
    """The last batch is committed to the sink but not to the checkpoint, and so runs again."""
    topic = J.landed_topic(spark, SF_SMALL, 3)
    table = load.TableFolder(spark, os.path.join(tmp_dir, "tips"), "window_day")
    sink = S.upsert_sink(table, ["window_start"], derive={"window_day": F.to_date("window_start")}, moves=False)
    ran = []
    run = lambda: S.run_bounded(J.hourly_tips(J._stream(spark, topic, 1)), os.path.join(tmp_dir, "ck"), "update",
                                sink=lambda b, i: (ran.append(i), sink(b, i))[1])
    run()
    cols = ["window_start", "window_end", "total_tip_amount"]
    before = as_set(table.read(), cols)
    assert before == as_set(J.hourly_tips(J.decoded(spark, SF_SMALL)), cols) and max(ran) >= 2
    last = max(ran)
    for f in (f"{last}", f".{last}.crc"):
        os.remove(os.path.join(tmp_dir, "ck", "commits", f))
    ran.clear()
    run()
    assert last in ran and as_set(table.read(), cols) == before
    assert table.read().count() == len(before)


def test_a_stopped_query_goes_on_where_it_stopped(spark, tmp_dir):
    topic = J.landed_topic(spark, SF_SMALL, 6)
    events = W.pass_through(J._stream(spark, topic, 1))
    ck, out = os.path.join(tmp_dir, "ck"), os.path.join(tmp_dir, "out")
    done = S.run_interrupted(events, ck, "append", out, batches=2)
    assert 2 <= done and 0 < spark.read.parquet(out).count()
    q = S.run_bounded(events, ck, "append", path=out)
    fresh = [p["batchId"] for p in q.recentProgress if p["numInputRows"]]
    assert not fresh or min(fresh) >= done
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, spark.read.parquet(out).collect()), key=key) == sorted(
        map(tuple, W.pass_through(J.decoded(spark, SF_SMALL)).collect()), key=key)
