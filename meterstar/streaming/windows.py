"""Event-time operators shared by batch and Structured Streaming (STR-1..9, SRC-10..12, SNK-15..18).

Every function takes and returns a DataFrame and works unchanged on a streaming DataFrame, so a
bounded batch run is the oracle of the streaming run.

Trip events travel as JSON text (the topic ``value``); ``parse_trip_events`` decodes them with a
declared schema: permissive (a bad line / field becomes NULL and is filtered) or fail-fast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterstar.functions.expr import TS_TEXT

TRIP_EVENT_SCHEMA = T.StructType([
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("passenger_count", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("lpep_pickup_datetime", T.StringType()),
    T.StructField("lpep_dropoff_datetime", T.StringType()),
])
TRIP_EVENT_FIELDS = [f.name for f in TRIP_EVENT_SCHEMA.fields]

WATERMARK = "5 seconds"


def _ntz(c: str) -> Column:
    """Window bounds as wall-clock TIMESTAMP_NTZ (no dependence on the reader's time zone)."""
    return F.col(c).cast("timestamp_ntz")


def to_messages(df: DataFrame, columns=None, key: str | Column | None = None) -> DataFrame:
    """SNK-18 / FN-19: rows -> JSON ``value`` (and optional ``key``) as a topic holds them."""
    cols = columns or df.columns
    out = [F.to_json(F.struct(*cols)).alias("value")]
    if key is not None:
        out.insert(0, (F.col(key) if isinstance(key, str) else key).cast("string").alias("key"))
    return df.select(*out)


def parse_trip_events(messages: DataFrame, strict: bool = False, value_col: str = "value") -> DataFrame:
    """SRC-11 / SRC-12 / FN-14: decode JSON trip events and derive ``event_time``.

    ``strict=False``: malformed JSON or fields give NULLs (the job ignores parse errors);
    ``strict=True``: the first malformed record fails the query.
    """
    opts = {"mode": "FAILFAST"} if strict else {"mode": "PERMISSIVE"}
    v = F.col(value_col).cast("string")
    # inline(array(struct)) yields the parsed fields as a one-row generator: later filters on the
    # fields stay above it instead of being inlined into the scan as repeated from_json calls,
    # so every message is parsed exactly once.
    parsed = messages.select(F.inline(F.array(F.from_json(v, TRIP_EVENT_SCHEMA, opts))))
    txt = F.col("lpep_pickup_datetime")
    ts = F.to_timestamp(txt, TS_TEXT) if strict else F.try_to_timestamp(txt, F.lit(TS_TEXT))
    # TIMESTAMP (session time zone UTC): watermarks require it; outputs are cast back to NTZ
    return parsed.withColumn("event_time", ts)


def pass_through(events: DataFrame) -> DataFrame:
    """STR-2: the processed-events projection with both timestamps parsed."""
    return events.select(
        "PULocationID", "DOLocationID", "passenger_count", "trip_distance", "tip_amount", "total_amount",
        F.try_to_timestamp("lpep_pickup_datetime", F.lit(TS_TEXT)).cast("timestamp_ntz").alias("pickup_datetime"),
        F.try_to_timestamp("lpep_dropoff_datetime", F.lit(TS_TEXT)).cast("timestamp_ntz").alias("dropoff_datetime"))


def guard(events: DataFrame, *required: str) -> DataFrame:
    """STR-8 / FLT-1: drop events missing the key or the event time before windowing."""
    for c in required:
        events = events.where(F.col(c).isNotNull())
    return events


def with_watermark(events: DataFrame, delay: str = WATERMARK, time_col: str = "event_time") -> DataFrame:
    """STR-1. No-op for batch DataFrames (Spark ignores it), binding for streams."""
    return events.withWatermark(time_col, delay)


def tumbling_counts(events: DataFrame, size: str, key: str, time_col: str = "event_time") -> DataFrame:
    """STR-3: count per (tumbling window, key) -> window_start, <key lower-case>, num_trips."""
    g = events.groupBy(F.window(time_col, size).alias("w"), F.col(key))
    return g.agg(F.count(F.lit(1)).alias("num_trips")).select(
        _ntz("w.start").alias("window_start"), F.col(key).alias(key.lower()), "num_trips")


def tumbling_sum(events: DataFrame, size: str, value: str, alias: str, time_col: str = "event_time",
                 value_type: str = "decimal(18,2)") -> DataFrame:
    """STR-4: global sum per tumbling window. The value is summed as an exact decimal so the
    result does not depend on the order rows meet in the shuffle."""
    g = events.groupBy(F.window(time_col, size).alias("w"))
    return g.agg(F.sum(F.col(value).cast(value_type)).cast("decimal(38,2)").alias(alias)).select(
        _ntz("w.start").alias("window_start"), _ntz("w.end").alias("window_end"), alias)


def session_counts(events: DataFrame, gap: str, key: str | None, time_col: str = "event_time") -> DataFrame:
    """STR-5 / STR-6: sessions per key (gap-separated), events exactly one gap apart merge.

    window_end is the last event plus the gap. ``key=None`` is the global session variant (batch
    only; Spark refuses a global session window on a stream).
    """
    keys = [F.col(key)] if key else []
    g = events.groupBy(F.session_window(time_col, gap).alias("w"), *keys)
    out = [_ntz("w.start").alias("window_start"), _ntz("w.end").alias("window_end")]
    if key:
        out.append(F.col(key).alias(key.lower()))
    return g.agg(F.count(F.lit(1)).alias("num_trips")).select(*out, "num_trips")


def session_counts_split(events: DataFrame, gap: str, key: str | None, time_col: str = "event_time",
                         buckets: int | None = None) -> DataFrame:
    """STR-5 / STR-6 for batch at any skew: same result as ``session_counts``.

    Spark's session aggregation shuffles on the key alone and merges sessions after the shuffle,
    so one key holding a third of all events lands in one task. Here:

    1. events are range-partitioned on (key, time, row hash) into ``buckets`` contiguous slices;
       the row hash lets even a run of identical (key, time) values spread over slices. The slice
       number is the bucket, so no key, hour or timestamp can pin a third of the data to one task;
    2. local sessions per (key, bucket) -- each bounded by one slice;
    3. only the first and last local session of a (key, bucket) can continue into a neighbouring
       slice; those edge rows (at most two per key and bucket: bounded by the bucket count, not by
       the data volume) are chained per key in time order, a new session starting when its first
       event is more than ``gap`` after the latest end seen so far (running max, exact for
       overlapping edges at a shared boundary timestamp);
    4. interior local sessions are final; chained groups are summed. Union of both.

    ``key=None`` gives the global session variant; its chaining step orders the edge rows of all
    buckets (at most ``2 * buckets``) in one window.
    """
    from pyspark.sql import Window

    spark = events.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    gap_expr = F.expr(f"INTERVAL {gap}")
    keys = [key] if key else []
    salt = F.xxhash64(*[F.col(c) for c in events.columns])
    ev = (events.repartitionByRange(n, *[F.col(k) for k in keys], F.col(time_col), salt)
          .select(*keys, time_col, F.spark_partition_id().alias("__bucket")))
    local = (ev.groupBy(*keys, "__bucket", F.session_window(time_col, gap).alias("w"))
             .agg(F.min(time_col).alias("__first"), F.max(time_col).alias("__last"),
                  F.count(F.lit(1)).alias("__n"))
             .drop("w"))
    per_bucket = Window.partitionBy(*keys, "__bucket")
    local = (local.withColumn("__is_first", F.col("__first") == F.min("__first").over(per_bucket))
             .withColumn("__is_last", F.col("__last") == F.max("__last").over(per_bucket)))
    interior = local.where(~F.col("__is_first") & ~F.col("__is_last")).select(
        *keys, F.col("__first").alias("__start"), "__last", "__n")
    edge = local.where(F.col("__is_first") | F.col("__is_last"))
    order = ["__first", "__last", "__bucket"]
    by_key = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
    seen_end = F.max("__last").over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    edge = edge.withColumn("__new", F.when(seen_end.isNull() | (F.col("__first") > seen_end + gap_expr), 1)
                           .otherwise(0))
    edge = edge.withColumn("__sid", F.sum("__new").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
    chained = edge.groupBy(*keys, "__sid").agg(F.min("__first").alias("__start"), F.max("__last").alias("__last"),
                                                F.sum("__n").alias("__n")).drop("__sid")
    sessions = interior.unionByName(chained)
    out = [_ntz("__start").alias("window_start"), (F.col("__last") + gap_expr).cast("timestamp_ntz").alias("window_end")]
    if key:
        out.append(F.col(key).alias(key.lower()))
    return sessions.select(*out, F.col("__n").cast("bigint").alias("num_trips"))


def longest_session(sessions: DataFrame, key: str = "pulocationid") -> DataFrame:
    """STR-7: the session with the most trips as the single ``id = 1`` row (ties: earliest start,
    then lowest key). ORDER BY + LIMIT 1 is a per-partition top-1 and a merge, never one task."""
    top = sessions.orderBy(F.col("num_trips").desc(), F.col("window_start").asc(), F.col(key).asc()).limit(1)
    return top.select(F.lit(1).alias("id"), key, "num_trips", "window_start", "window_end")


def count_with_predicate(events: DataFrame, predicate: Column, alias: str) -> DataFrame:
    """AG-12 / SRC-14: total records and records satisfying ``predicate`` in one pass."""
    return events.agg(F.count(F.lit(1)).alias("record_count"), F.count_if(predicate).alias(alias))
