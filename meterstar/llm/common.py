"""What several operators of this folder share: words, hashes, staged tables and components."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Runs of anything but ASCII blanks (fixed by the contracts of the word based queries).
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (``spark.checkpoint.dir``).

    A scratch folder is made only in a plain ``local`` session that names none, as in tests.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="llm-shared-"))
    return spark.conf.get("spark.checkpoint.dir")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor makes later stages read files again, not repeat the work.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    spark._jvm.System.gc()  # Spark's cleaner deletes shuffle files once their plans are collected
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete a table made by ``staged`` that nothing reads any more."""
    spark = df.sparkSession
    for f in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def text_fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts


def word_bytes(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words; ``bytes.split`` and ``bytes.lower`` know ASCII only, as WORD does."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


_MUL, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MUL
    return x ^ (x >> np.uint64(32))


def shingle_hashes(h: np.ndarray, k: int = 5) -> np.ndarray:
    """A 64-bit hash of each run of ``k`` words; with fewer words, one of the whole sequence."""
    if len(h) == 0:
        return h
    run = min(k, len(h))
    acc = h[: len(h) - run + 1].copy()
    for j in range(1, run):
        acc = acc * _MUL + h[j: len(h) - run + 1 + j]
    return mixed(acc + np.uint64(run))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of ``links``: one row (node, root) per linked node, root its smallest node.

    Alternates the large-star and small-star steps; each round is two grouped joins on the
    links and is staged, so neither links nor components ever pass through the driver. Stops when
    a round changes nothing.
    """
    lo, hi = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    edges = staged(links.where(F.col(a) != F.col(b)).select(hi.alias("u"), lo.alias("v")).distinct(), "links")
    state = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == mark:
            break
        state = mark
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        old, edges = edges, staged(small.where("u <> v").distinct(), "links")
        drop_staged(old)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select("v", "v")).distinct()
