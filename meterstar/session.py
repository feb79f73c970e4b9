"""Session defaults: UTC, ANSI, AQE. Nothing else is global."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library relies on. They are plain Spark settings.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Interval replace rewrites only the partitions it touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # counts, minima and maxima of whole columns come from footers where a V2 scan is used (files.footer_table)
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.ui.enabled": "false",
}


def scale_settings(input_bytes: int, executor_cores: int, partition_mb: int = 256) -> dict[str, str]:
    """Partition sizing for a job reading ``input_bytes`` on ``executor_cores`` cores in total.

    Scan splits and shuffle partitions target ``partition_mb`` each, so a task's working set fits
    an executor core's share of memory (and spills in sort / aggregation stay rare). The shuffle
    partition count is an upper bound: AQE coalesces small ones and splits skewed ones at run time.
    100 TB at 256 MB gives ~400k scan tasks and ~400k shuffle partitions before coalescing.
    """
    part = partition_mb * 1024 * 1024
    n = max(2 * executor_cores, -(-input_bytes // part))
    return {
        "spark.sql.files.maxPartitionBytes": str(part),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(part),
        # coalesce towards the advisory size (the default favours parallelism and leaves 1 MB parts)
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * part),
    }


def get_session(master: str | None = None, app: str = "meterstar", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster ``master`` stays None so the launcher decides; ``shuffle_partitions`` should then
    be sized so one shuffle partition holds roughly 128-256 MB of the largest exchange.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply the SQL defaults to an existing session (the driver hands us its own)."""
    for k, v in SESSION_DEFAULTS.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged tables, read from ``spark.checkpoint.dir``.

    Only a plain ``local`` session that names none (tests, a laptop) gets a scratch folder of its
    own. Everywhere else an unset folder is refused: a machine-local one does not survive a lost
    executor.
    """
    sc = _context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc is not None else None)
    if not root:
        master = str(sc.master if sc is not None else spark.conf.get("spark.master", ""))
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="meterstar-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint root (staged writes, versioned tables)."""
    return os.path.join(checkpoint_root(spark), *parts)


def materialized(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage: later actions (several checks, several reports) scan the written table
    instead of recomputing the whole upstream plan, and a lost executor re-reads files instead of
    re-running upstream stages. The folder name is unique per call.
    """
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies (no error when it is gone already)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def drop_materialized(df) -> None:
    """Delete the staged copy that ``materialized`` made, once nothing reads it any more."""
    for f in df.inputFiles()[:1]:
        delete_path(df.sparkSession, os.path.dirname(f))
