"""Structured Streaming sources, sinks and bounded runs (SRC-10/11/14, SNK-15/16, STR-9..12).

Sources: Kafka when the connector is on the class path (``format="kafka"``), or a folder of JSON
message files (the same ``value`` column) -- the code path after the source is identical.
Sinks: the built-in Parquet file sink for append (exactly once through its own log), and
``foreachBatch`` into a ``TableFolder`` for keyed upserts / complete results. A replayed micro-batch
rewrites the same keys with the same values, so the keyed sinks are idempotent.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterstar.operators import load
from meterstar.session import drop_materialized, materialized

MESSAGE_SCHEMA = T.StructType([T.StructField("value", T.StringType())])


def read_topic(spark: SparkSession, topic: str, bootstrap: str | None = None, path: str | None = None,
               starting: str = "latest", max_per_trigger: int | None = None, group_id: str | None = None) -> DataFrame:
    """SRC-10/11/12: a stream of message ``value`` strings.

    With ``bootstrap`` the Kafka source is used (``startingOffsets`` = latest|earliest; the consumer
    position lives in the query checkpoint). With ``path`` every JSON-lines file in the folder is one
    batch of messages (tests, replays).
    """
    if bootstrap:
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
             .option("subscribe", topic).option("startingOffsets", starting))
        if group_id:
            r = r.option("kafka.group.id", group_id)
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        return r.load().selectExpr("CAST(value AS STRING) AS value")
    if not path:
        raise ValueError("either bootstrap servers or a message folder is needed")
    r = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", max_per_trigger or 1000)
    return r.json(path)


def read_topic_batch(spark: SparkSession, topic: str, bootstrap: str | None = None, path: str | None = None) -> DataFrame:
    """SRC-11/14 bounded form: everything from the earliest to the latest offset, as a batch."""
    if bootstrap:
        return (spark.read.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("subscribe", topic)
                .option("startingOffsets", "earliest").option("endingOffsets", "latest").load()
                .selectExpr("CAST(value AS STRING) AS value"))
    return spark.read.schema(MESSAGE_SCHEMA).json(path)


def publish(messages: DataFrame, topic: str, bootstrap: str | None = None, path: str | None = None) -> None:
    """SNK-18: publish ``value`` (and optional ``key``) messages -- to Kafka when bootstrap servers
    are given, else as JSON-lines files in ``path`` (the folder ``read_topic`` consumes). Each
    task writes its own partition of the messages; nothing passes through the driver."""
    if bootstrap:
        (messages.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("topic", topic).save())
        return
    if not path:
        raise ValueError("either bootstrap servers or a message folder is needed")
    messages.write.mode("append").json(path)


def upsert_sink(table: load.TableFolder, key: Sequence[str], derive: dict | None = None,
                moves: bool = True) -> Callable[[DataFrame, int], None]:
    """SNK-16: foreachBatch writer merging each micro-batch into a keyed table. A batch that is replayed after a
    failure replaces its own rows, so it changes nothing.

    ``derive`` adds columns before the merge, typically the table's partition column (e.g.
    ``{"window_day": F.to_date("window_start")}``): a micro-batch then rewrites only the days it
    touches, and reads only those with ``moves=False`` (the derived column depends on the key alone). The
    micro-batch is staged once, so its plan (which reads and commits the state) runs once: by the merge, and here
    for the batch that begins a table with folders, as ranging its rows over them reads it twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        for name, col in (derive or {}).items():
            batch = batch.withColumn(name, col)
        begins = table.partition_by and not table.exists()
        if begins:
            batch = materialized(batch, "batch")
        load.materialize(batch.sparkSession, batch, "merge", table, key=key, moves=moves)
        if begins:
            drop_materialized(batch)
    return write


def replace_sink(table: load.TableFolder) -> Callable[[DataFrame, int], None]:
    """Complete-mode writer: each micro-batch carries the whole result, which replaces the table.

    Only for results that stay small (a handful of groups); growing results use ``append`` or ``update``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        table.replace(batch)
    return write


def run_unbounded(df: DataFrame, checkpoint: str, mode: str, every: str = "10 seconds",
                  sink: Callable | None = None, path: str | None = None, name: str | None = None) -> StreamingQuery:
    """STR-2 / STR-10: a long-running query with a micro-batch every ``every``; offsets and state
    are committed to ``checkpoint`` at each batch (the recovery point). Returns the running query."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(processingTime=every)
    if name:
        w = w.queryName(name)
    return w.foreachBatch(sink).start() if sink is not None else w.format("parquet").start(path)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes that lie in a folder, on whatever file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def state_parts(spark: SparkSession, topic_bytes: int, part_mb: int = 64) -> int:
    """Partitions for the state of a query over a topic: one per ``part_mb`` of messages, one per core at least.

    Every micro-batch opens and commits each of them, however few rows it holds.
    """
    return max(spark.sparkContext.defaultParallelism, -(-topic_bytes // (part_mb << 20)))


def run_bounded(df: DataFrame, checkpoint: str, mode: str, sink: Callable | None = None,
                path: str | None = None, name: str | None = None, parts: int | None = None) -> StreamingQuery:
    """STR-9/STR-10: process everything available, then stop (``trigger(availableNow=True)``).

    In ``append`` mode a window comes out once the watermark has passed it; the last ones need a closing
    event behind them (``update`` with a keyed sink does not). ``parts`` is the number of state partitions of a
    new query (else as many as a shuffle has); one that goes on from its checkpoint keeps its own.
    """
    if parts:
        key, conf = "spark.sql.shuffle.partitions", df.sparkSession.conf
        before = conf.get(key)
        conf.set(key, parts)   # a query takes its settings along when it starts
        try:
            return run_bounded(df, checkpoint, mode, sink, path, name)
        finally:
            conf.set(key, before)
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        w = w.queryName(name)
    if sink is not None:
        q = w.foreachBatch(sink).start()
    else:
        q = w.format("parquet").start(path)
    q.awaitTermination()
    return q


def publish_in_order(messages: DataFrame, time_col: str, path: str, files: int | None = None,
                     value: Column | None = None) -> None:
    """SNK-18 for a replay: message files that a stream reads in the order of ``time_col`` (which is not published).

    ``value`` gives the text of a message from the columns of ``messages``; it is made where the files are written,
    so that neither the sample for the ranges nor the shuffle carries it.
    Messages are range-partitioned by time, and the files' times follow their names, as a file stream
    takes the oldest files first. Lateness is judged between micro-batches, so however many files one
    takes, no message is late. Files published later come after those that are there.
    """
    spark, n = messages.sparkSession, files or int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = lambda: {f.getPath().getName(): f for f in fs.listStatus(folder)} if fs.exists(folder) else {}
    before = listed()
    dealt = messages.repartitionByRange(n, time_col)
    dealt = dealt.drop(time_col) if value is None else dealt.select(value.alias("value"))
    dealt.write.mode("append").json(path)
    new = sorted(name for name in listed() if name not in before and name.startswith("part-"))
    start = max([int(time.time() * 1000) - 10 * len(new), *(f.getModificationTime() for f in before.values())])
    for k, name in enumerate(new, 1):
        fs.setTimes(folder.suffix(f"/{name}"), start + 10 * k, -1)


def run_interrupted(df: DataFrame, checkpoint: str, mode: str, path: str, batches: int = 1) -> int:
    """STR-10: start a file sink query, stop it once ``batches`` micro-batches are done; returns how many were.

    A later run on the same ``checkpoint`` goes on behind the last committed batch; a batch that was cut off
    is run again with the same files, and the sink's own log keeps it from being written twice.
    """
    q = run_unbounded(df, checkpoint, mode, every="0 seconds", path=path)
    try:
        while q.isActive and (q.lastProgress is None or q.lastProgress["batchId"] + 1 < batches):
            time.sleep(0.05)
        if q.exception():
            raise q.exception()
    finally:
        q.stop()
    return q.lastProgress["batchId"] + 1
