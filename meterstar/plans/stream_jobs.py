"""Trip-event stream jobs (Q-M7-*), bound to the driver ``events`` table.

The topic is produced from ``events`` exactly as the reference producer serialises rides: one JSON
message per event (SNK-18). Mapping: PULocationID = user_id, DOLocationID = event_id mod 265,
trip_distance = tip_amount = total_amount = value, pickup text = ts formatted to whole seconds,
dropoff = pickup + 10 minutes. The jobs then decode the messages (SRC-11) and window them.

Every job is registered twice: ``m7_*`` in batch form, and ``stream_*`` as a Structured Streaming run over
message files in the shared folder, in several micro-batches, whose sink is read back. The SQL is the same.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.functions.expr import TS_TEXT
from meterstar.operators import load
from meterstar.plans.registry import query
from meterstar.session import scratch_path
from meterstar.sources import driver_tables as D
from meterstar.streaming import jobs as S
from meterstar.streaming import windows as W

TUMBLE = "5 minutes"
HOUR = "1 hour"
SESSION_GAP = "5 minutes"
DISTANCE_OVER = 5


def _ride(**instead: Column) -> list[Column]:
    """The fields of a trip event from an event row; ``instead`` replaces some."""
    fields = {
        "PULocationID": F.col("user_id").cast("int"),
        "DOLocationID": (F.col("event_id") % 265).cast("int"),
        "passenger_count": F.lit(1),
        "trip_distance": F.col("value"),
        "tip_amount": F.col("value"),
        "total_amount": F.col("value"),
        "lpep_pickup_datetime": F.date_format("ts", TS_TEXT),
        "lpep_dropoff_datetime": F.date_format(F.col("ts") + F.expr("INTERVAL 10 MINUTES"), TS_TEXT)}
    return [c.alias(name) for name, c in (fields | instead).items()]


def trip_events_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.events(spark, sf_dir).select(*_ride())


def trip_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages a producer would publish for the events table (``value`` JSON text)."""
    return W.to_messages(trip_events_frame(spark, sf_dir), W.TRIP_EVENT_FIELDS)


def decoded(spark, sf_dir, strict=False) -> DataFrame:
    return W.parse_trip_events(trip_topic(spark, sf_dir), strict=strict)


def five_minute_counts(events: DataFrame) -> DataFrame:
    ev = W.with_watermark(W.guard(events, "PULocationID", "lpep_pickup_datetime", "event_time"))
    return W.tumbling_counts(ev, TUMBLE, "PULocationID")


def hourly_tips(events: DataFrame) -> DataFrame:
    ev = W.with_watermark(W.guard(events, "tip_amount", "lpep_pickup_datetime", "event_time"))
    return W.tumbling_sum(ev, HOUR, "tip_amount", "total_tip_amount")


def zone_sessions(events: DataFrame) -> DataFrame:
    """Sessions per zone. Streams use Spark's stateful session window; batch runs use the
    skew-tolerant split form (same result, checked in tests)."""
    ev = W.guard(events, "PULocationID", "lpep_pickup_datetime", "event_time")
    if events.isStreaming:
        return W.session_counts(W.with_watermark(ev), SESSION_GAP, "PULocationID")
    return W.session_counts_split(ev, SESSION_GAP, "PULocationID")


def global_sessions(events: DataFrame) -> DataFrame:
    """STR-6: sessions over all zones together (batch only)."""
    ev = W.guard(events, "lpep_pickup_datetime", "event_time")
    return W.session_counts_split(ev, SESSION_GAP, None)


_EV_SQL = """WITH ev AS (
  SELECT CAST(user_id AS INTEGER) AS pulocationid, CAST(event_id % 265 AS INTEGER) AS dolocationid,
         value AS tip_amount, value AS trip_distance, value AS total_amount,
         date_trunc('second', ts) AS event_time, date_trunc('second', ts + INTERVAL 10 MINUTE) AS dropoff_time
  FROM events)
"""

_SESSIONS_SQL = _EV_SQL + f""",
marked AS (
  SELECT pulocationid, event_time,
         CASE WHEN event_time - lag(event_time) OVER (PARTITION BY pulocationid ORDER BY event_time)
                   <= INTERVAL '{SESSION_GAP}' THEN 0 ELSE 1 END AS new_session
  FROM ev),
numbered AS (
  SELECT *, sum(new_session) OVER (PARTITION BY pulocationid ORDER BY event_time
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM marked),
sessions AS (
  SELECT min(event_time) AS window_start, max(event_time) + INTERVAL '{SESSION_GAP}' AS window_end,
         pulocationid, count(*) AS num_trips
  FROM numbered GROUP BY pulocationid, sid)
"""


@query("m7_consumer_distance_count", covers="Q-M7-0 SRC-14 AG-12 FLT-6 FN-19", sql=_EV_SQL + f"""
SELECT count(*) AS record_count, CAST(count_if(trip_distance > {DISTANCE_OVER}) AS BIGINT) AS distance_over_5 FROM ev""")
def m7_consumer_distance_count(spark, sf_dir):
    return W.count_with_predicate(decoded(spark, sf_dir), F.col("trip_distance") > DISTANCE_OVER, "distance_over_5")


@query("m7_pass_through", covers="Q-M7-1 STR-2 SRC-12 FN-14 FN-15 SNK-18", sql=_EV_SQL + """
SELECT pulocationid AS PULocationID, dolocationid AS DOLocationID, 1 AS passenger_count, trip_distance,
       tip_amount, total_amount, event_time AS pickup_datetime, dropoff_time AS dropoff_datetime FROM ev""")
def m7_pass_through(spark, sf_dir):
    return W.pass_through(decoded(spark, sf_dir, strict=True))


@query("m7_five_minute_zone_counts", covers="Q-M7-2 STR-3 STR-8 SRC-11 FLT-1 FN-21", sql=_EV_SQL + f"""
SELECT time_bucket(INTERVAL '{TUMBLE}', event_time) AS window_start, pulocationid, count(*) AS num_trips
FROM ev GROUP BY 1, 2""")
def m7_five_minute_zone_counts(spark, sf_dir):
    return five_minute_counts(decoded(spark, sf_dir))


@query("m7_hourly_tips", covers="Q-M7-3 STR-4", sql=_EV_SQL + f"""
SELECT time_bucket(INTERVAL '{HOUR}', event_time) AS window_start,
       time_bucket(INTERVAL '{HOUR}', event_time) + INTERVAL '{HOUR}' AS window_end,
       CAST(sum(CAST(tip_amount AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_tip_amount
FROM ev GROUP BY 1, 2""")
def m7_hourly_tips(spark, sf_dir):
    return hourly_tips(decoded(spark, sf_dir))


@query("m7_zone_sessions", covers="Q-M7-4 STR-5 STR-8", sql=_SESSIONS_SQL + "SELECT * FROM sessions")
def m7_zone_sessions(spark, sf_dir):
    return zone_sessions(decoded(spark, sf_dir))


_GLOBAL_SQL = _EV_SQL + f""",
marked AS (
  SELECT event_time,
         CASE WHEN event_time - lag(event_time) OVER (ORDER BY event_time) <= INTERVAL '{SESSION_GAP}'
              THEN 0 ELSE 1 END AS new_session
  FROM ev),
numbered AS (
  SELECT *, sum(new_session) OVER (ORDER BY event_time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM marked)
SELECT min(event_time) AS window_start, max(event_time) + INTERVAL '{SESSION_GAP}' AS window_end,
       count(*) AS num_trips
FROM numbered GROUP BY sid"""


@query("m7_global_sessions", covers="STR-6", sql=_GLOBAL_SQL)
def m7_global_sessions(spark, sf_dir):
    return global_sessions(decoded(spark, sf_dir))


@query("m7_longest_session", covers="Q-M7-5 STR-7 WN-2", sql=_SESSIONS_SQL + """
SELECT 1 AS id, pulocationid, num_trips, window_start, window_end FROM sessions
ORDER BY num_trips DESC, window_start ASC, pulocationid ASC LIMIT 1""")
def m7_longest_session(spark, sf_dir):
    return W.longest_session(zone_sessions(decoded(spark, sf_dir)))


# --- the same jobs as streams ---------------------------------------------------------------------------
# A topic lies as message files in event-time order. Runs are bounded (they end when all files are read).

MICRO_BATCHES = 4
CLOSING_TIME, CLOSING_ZONE = "9999-01-01 00:00:00", -1   # an event behind all others lets the last sessions end


def landed_topic(spark: SparkSession, sf_dir: str, files: int, close: bool = False) -> str:
    """The trip topic as message files (SNK-18), oldest events first; ``close`` adds the closing event."""
    path = scratch_path(spark, "topics", f"trips-{uuid.uuid4().hex}")
    events = D.events(spark, sf_dir).select("event_id", "user_id", "value", "ts")
    S.publish_in_order(events, "ts", path, files, value=F.to_json(F.struct(*_ride())))
    if close:
        last = _ride(PULocationID=F.lit(CLOSING_ZONE), lpep_pickup_datetime=F.lit(CLOSING_TIME))
        S.publish_in_order(events.limit(1), "ts", path, 1, value=F.to_json(F.struct(*last)))
    return path


def _files(spark: SparkSession) -> int:
    """Message files of a topic: as many as a shuffle has partitions, one a micro-batch at least."""
    return max(MICRO_BATCHES, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _stream(spark: SparkSession, topic: str, per_batch: int, strict: bool = False) -> DataFrame:
    return W.parse_trip_events(S.read_topic(spark, "trips", path=topic, max_per_trigger=per_batch), strict=strict)


def _sink(spark: SparkSession, name: str, partition_by: str | None = None) -> tuple[load.TableFolder, str]:
    """A sink table and the checkpoint of its query, both in the shared folder."""
    at = scratch_path(spark, "streams", f"{name}-{uuid.uuid4().hex}")
    return load.TableFolder(spark, f"{at}/table", partition_by), f"{at}/checkpoint"


def sessions_sink(spark: SparkSession, sf_dir: str) -> load.TableFolder:
    """Q-M7-4 as a stream: append mode, so a session is written once, when the watermark has passed its end."""
    files = _files(spark)
    topic = landed_topic(spark, sf_dir, files, close=True)
    table, checkpoint = _sink(spark, "sessions", "session_day")
    S.run_bounded(zone_sessions(_stream(spark, topic, -(-files // MICRO_BATCHES))), checkpoint, "append",
                  sink=S.upsert_sink(table, ["window_start", "pulocationid"],
                                     derive={"session_day": F.to_date("window_start")}, moves=False),
                  parts=S.state_parts(spark, S.folder_bytes(spark, topic)))
    return table


@query("stream_zone_sessions", covers="Q-M7-4 STR-1 STR-5 STR-9 STR-11 SNK-16 SRC-10 SRC-12", sql=_SESSIONS_SQL + "SELECT * FROM sessions")
def stream_zone_sessions(spark, sf_dir):
    return sessions_sink(spark, sf_dir).read().select("window_start", "window_end", "pulocationid", "num_trips")


@query("stream_longest_session", covers="Q-M7-5 STR-7 STR-9 SNK-16", sql=_SESSIONS_SQL + """
SELECT 1 AS id, pulocationid, num_trips, window_start, window_end FROM sessions
ORDER BY num_trips DESC, window_start ASC, pulocationid ASC LIMIT 1""")
def stream_longest_session(spark, sf_dir):
    """The top session, read from the table that the session job writes."""
    return W.longest_session(sessions_sink(spark, sf_dir).read())


@query("stream_hourly_tips", covers="Q-M7-3 STR-1 STR-4 STR-9 SNK-16 SRC-12", sql=_EV_SQL + f"""
SELECT time_bucket(INTERVAL '{HOUR}', event_time) AS window_start,
       time_bucket(INTERVAL '{HOUR}', event_time) + INTERVAL '{HOUR}' AS window_end,
       CAST(sum(CAST(tip_amount AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_tip_amount
FROM ev GROUP BY 1, 2""")
def stream_hourly_tips(spark, sf_dir):
    """Update mode: every micro-batch (one file) sends the windows it changed, the keyed sink replaces them."""
    topic = landed_topic(spark, sf_dir, MICRO_BATCHES)
    table, checkpoint = _sink(spark, "tips", "window_day")
    S.run_bounded(hourly_tips(_stream(spark, topic, 1)), checkpoint, "update",
                  sink=S.upsert_sink(table, ["window_start"], derive={"window_day": F.to_date("window_start")}, moves=False),
                  parts=S.state_parts(spark, S.folder_bytes(spark, topic)))
    return table.read().select("window_start", "window_end", "total_tip_amount")


@query("stream_pass_through", covers="Q-M7-1 STR-2 STR-9 STR-10 SNK-15 SRC-10 SRC-12", sql=_EV_SQL + """
SELECT pulocationid AS PULocationID, dolocationid AS DOLocationID, 1 AS passenger_count, trip_distance,
       tip_amount, total_amount, event_time AS pickup_datetime, dropoff_time AS dropoff_datetime FROM ev""")
def stream_pass_through(spark, sf_dir):
    """A query that is stopped on the way and started again on its checkpoint; its file sink has every event once."""
    topic = landed_topic(spark, sf_dir, 2 * MICRO_BATCHES)
    at = scratch_path(spark, "streams", f"processed-{uuid.uuid4().hex}")
    events = W.pass_through(_stream(spark, topic, 1, strict=True))
    S.run_interrupted(events, f"{at}/checkpoint", "append", path=f"{at}/table")
    S.run_bounded(events, f"{at}/checkpoint", "append", path=f"{at}/table")
    return spark.read.schema(events.schema).parquet(f"{at}/table")


@query("window_counts_table", covers="Q-M7-2 SNK-17 SRC-11 SRC-14 STR-3", sql=_EV_SQL + f"""
SELECT time_bucket(INTERVAL '{TUMBLE}', event_time) AS window_start, pulocationid, count(*) AS num_trips
FROM ev GROUP BY 1, 2""")
def window_counts_table(spark, sf_dir):
    """A bounded read of the topic from its first to its last message; the windows are inserted into a table."""
    topic = landed_topic(spark, sf_dir, _files(spark))
    table, _ = _sink(spark, "counts", "window_day")
    counts = five_minute_counts(W.parse_trip_events(S.read_topic_batch(spark, "trips", path=topic)))
    load.materialize(spark, counts.withColumn("window_day", F.to_date("window_start")), "append", table)
    return table.read().select("window_start", "pulocationid", "num_trips")
