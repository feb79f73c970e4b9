"""JDBC tables (SRC-13, SNK-2, SNK-15): thin wrappers over Spark's JDBC data source.

On a cluster the URL names a shared database reachable from every executor. The test suite does
not start a database server; these functions need a JDBC driver on the class path.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None) -> DataFrame:
    """Parallel JDBC scan when a numeric partition column and bounds are given."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    return r.load()


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None,
                truncate: bool = True) -> None:
    """append, or overwrite keeping the table definition (truncate) -- the full-refresh load."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("truncate", truncate)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()


def append_sink(url: str, table: str, properties: dict | None = None) -> Callable[[DataFrame, int], None]:
    """SNK-15: foreachBatch writer appending each micro-batch to a JDBC table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_table(batch, url, table, "append", properties)
    return write
