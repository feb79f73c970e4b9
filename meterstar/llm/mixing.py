"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterstar.llm.common import WORD, staged

HASH_HEX = 15          # hex digits of the document's hash: 60 bits
LEVEL_BITS = 12        # bits that one histogram level tells apart
LEVELS = 5             # LEVEL_BITS * LEVELS = 60 bits


def hash60(id_col: Column) -> Column:
    """First 60 bits of the MD5 of the id as text (null: of the empty text)."""
    return F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), 1, HASH_HEX),
                  16, 10).cast("bigint")


def source_targets(totals: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """Targets of sources: ``totals`` has (source, source_size); adds ``target``.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` times all sizes.
    A target stops at ``most`` times its source's size and the excess is shared by weight among the
    rest. That is: with sources ordered by (most * size / weight), the first ones are full; for each
    possible number of full ones the level ``(budget - their caps) / remaining weight`` is known, and
    the right one is the first whose level does not pass the next source's ratio. One row per source
    goes through a single ordered window, as the order of sources itself asks for; rows of documents
    never do.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    t = totals.withColumn("weight", w).withColumn("top", F.lit(most) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("top") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before, every = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    t = t.select("*", (F.lit(share) * F.sum("source_size").over(every)
                       - F.coalesce(F.sum("top").over(before), F.lit(0.0))).alias("budget"),
                 F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)).alias("open_weight"),
                 F.col("top").alias("cap"))
    fits = F.col("budget") / F.col("open_weight") <= F.col("cap") / F.col("weight")
    t = t.withColumn("place", F.row_number().over(by_ratio))
    level = F.min(F.when(fits, F.struct("place", F.col("budget") / F.col("open_weight")))).over(every)["col2"]
    target = F.when(level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("weight") * level))
    return t.select("source", "source_size", target.alias("target"))


def _bucket(level: int) -> Column:
    return F.shiftright("h", 60 - LEVEL_BITS * (level + 1)).bitwiseAND((1 << LEVEL_BITS) - 1)


def _thresholds(sizes: DataFrame, budget: DataFrame) -> DataFrame:
    """Per source: ``edge``, the hash at the budget, and ``spare``, the words left for that hash.

    Level by level: one histogram of words by (source, next bits of the hash), summed on the map
    side, finds the bucket in which the running sum passes the budget; only rows of that bucket
    enter the next level. No row is sorted; a histogram has at most 2^LEVEL_BITS rows per source.
    """
    at = budget.select(F.col("source").alias("s"), F.lit(0).cast("bigint").alias("edge"), F.col("budget").alias("spare"))
    run = Window.partitionBy("s").orderBy("bucket")
    for level in range(LEVELS):
        inside = F.shiftright("h", 60 - LEVEL_BITS * level) == F.col("edge")
        hist = (sizes.join(at, sizes["source"].eqNullSafe(at["s"]) & inside)
                .groupBy("s", "edge", "spare", _bucket(level).alias("bucket")).agg(F.sum("size").alias("words")))
        hist = hist.select("*", (F.sum("words").over(run) - F.col("words")).alias("below"))
        # the last bucket that starts within the budget is the boundary bucket
        found = (hist.where(F.col("below") <= F.col("spare")).groupBy("s")
                 .agg(F.max_by(F.struct((F.col("edge") * (1 << LEVEL_BITS) + F.col("bucket")).alias("edge"),
                                        (F.col("spare") - F.col("below")).alias("spare")), "bucket").alias("x")))
        at = staged(found.select("s", "x.*"), "edges")
    return at


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, keep: bool = False) -> DataFrame:
    """How many words of each document a mix to target weights takes.

    Returns one row per row of ``docs``: ``doc_id, size, source_size, target, taken`` (with ``keep``,
    after all columns of ``docs``, prefixed ``mix_``). Where a target is at least the source's size,
    every document is taken whole and the rest of the target once more from documents under a hash
    threshold. The document at the threshold gives the words that are still missing, so each source
    meets its target to a word; documents with the same hash (repeated ids) share that remainder in
    proportion to their sizes. Null text or no words: size 0, taken 0; a null source is a source of
    its own; an empty table gives an empty result. Reruns agree, as only ids and sizes decide.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    # the few columns that all levels read; texts are scanned once
    sizes = staged(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                               size.alias("size"), hash60(F.col(id_col)).alias("h")), "sizes")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = staged(source_targets(totals, weights, share, most), "targets")
    full = F.col("target") >= F.col("source_size")
    wanted = F.round("target").cast("bigint")
    plan = targets.select("*", F.when(full, 1).otherwise(0).alias("whole"),
                          (wanted - F.when(full, F.col("source_size")).otherwise(0)).alias("budget"))
    edge = _thresholds(sizes.where("size > 0"), plan.where("budget > 0"))
    # words that carry the boundary hash itself: one document, or copies of one id
    tied = (sizes.join(edge, sizes["source"].eqNullSafe(edge["s"]) & (F.col("h") == F.col("edge")))
            .groupBy("s", "edge", "spare").agg(F.sum("size").alias("tied")))
    plan = plan.join(tied, plan["source"].eqNullSafe(tied["s"]), "left").select(
        F.col("source").alias("s"), "source_size", "target", "whole", "edge", "spare", "tied")
    plan = staged(plan, "mix-plan")
    part = (F.when(F.col("edge").isNull() | (F.col("h") > F.col("edge")), F.lit(0).cast("bigint"))
            .when(F.col("h") < F.col("edge"), F.col("size"))
            .otherwise(F.least(F.col("size"), F.floor(F.col("spare").cast("decimal(20,0)") * F.col("size") / F.col("tied")))))
    taken = (F.col("whole") * F.col("size") + part).cast("bigint")
    if not keep:
        return (sizes.join(plan, sizes["source"].eqNullSafe(plan["s"]))
                .select("doc_id", "size", "source_size", "target", taken.alias("taken")))
    d = docs.select(F.struct(*docs.columns).alias("row"), F.col(source_col).alias("source"), size.alias("size"),
                    hash60(F.col(id_col)).alias("h"))
    return (d.join(plan, d["source"].eqNullSafe(plan["s"]))
            .select("row.*", F.col("size").alias("mix_size"), F.col("source_size").alias("mix_source_size"),
                    F.col("target").alias("mix_target"), taken.alias("mix_taken")))
