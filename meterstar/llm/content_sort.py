"""Exact dedup by sorting contents: equal texts become neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterstar.llm.common import staged

HEAD = 64        # bytes of a text that a range splitter holds, beside its 64-bit hash
SHARE = 4096     # a group of more than 1/SHARE of all rows is sorted as several runs


def equal_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of rows with identical texts: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Contents are range-partitioned by sampled splitters and sorted, which places equal texts side by
    side; the window then compares each whole text with its neighbour's, and the first row of a run
    (largest id) stays. Splitters order texts by (first ``HEAD`` bytes, hash, run), so the driver's
    sample holds under a hundred bytes a key, and a million texts with the same head still spread;
    the hash never decides equality, the whole text is the last sort key.

    A group with more than 1/``SHARE`` of all rows is dealt to several runs, each sorted alone. Of these
    groups (under ``SHARE``, so their table may be broadcast) the heads of runs, with their whole
    texts, meet in a second small aggregate.

    Nulls count as the empty text; a null id is the smallest. Of repeated rows with the group's largest
    id exactly one is kept. An empty table gives an empty result. One row per input row.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.select("*", F.substring(F.col("text").cast("binary"), 1, HEAD).alias("head"), F.xxhash64("text").alias("h"))
    run = docs.count() // SHARE + 1
    large = (d.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > run)
             .select("h", F.ceil(F.col("n") / run).alias("runs")))
    # rows of one id may repeat: their input partition tells them apart too
    d = (d.join(F.broadcast(large), "h", "left")
         .withColumn("run", F.when(F.col("runs").isNull(), F.lit(0).cast("bigint"))
                     .otherwise(F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.col("runs")))))
    same = Window.partitionBy("head", "h", "run", "text")
    sort = same.orderBy(F.col("doc_id").desc_nulls_last())
    ranged = d.repartitionByRange("head", "h", "run").select(
        "doc_id", "run", F.col("runs").isNotNull().alias("split"), F.sha2("text", 256).alias("text_sha256"),
        F.first("doc_id").over(sort).alias("run_keep"), F.row_number().over(sort).alias("place"),
        F.count("*").over(same).alias("run_size"), "text")
    first = F.col("place") == 1
    rows = staged(ranged.withColumn("text", F.when(F.col("split") & first, F.col("text"))), "equal-runs")
    best = F.max(F.struct("run_keep", (-F.col("run")).alias("back")))  # null ids are the smallest
    groups = (rows.where(F.col("split") & first).groupBy("text")
              .agg(best.alias("best"), F.sum("run_size").alias("size"), F.first("text_sha256").alias("sha"))
              .select("sha", "size", F.col("best.run_keep").alias("best_id"), (-F.col("best.back")).alias("best_run")))
    whole = F.col("sha").isNull()
    return (rows.join(F.broadcast(groups), F.col("split") & (F.col("text_sha256") == F.col("sha")), "left")
            .select("doc_id", F.when(whole, F.col("run_keep")).otherwise(F.col("best_id")).alias("keep_id"),
                    F.coalesce("size", "run_size").alias("group_size"),
                    (first & (whole | (F.col("run") == F.col("best_run")))).alias("kept"), "text_sha256"))
