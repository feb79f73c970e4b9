"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

1. quality: texts that the nearest-neighbour quality classifier rejects go.
2. near_duplicates: one document of each group of the n-gram Jaccard join stays.
3. decontamination: texts that overlap a benchmark item go.
4. pii: personal data becomes format-preserving pseudonyms.
5. mixing: documents of which a mix of the sources to target weights takes no word go; the others say
   how many words it takes of them (``mix_taken``: fewer than ``mix_size`` for a part, more for a repeat).

All stages but the last return the columns of ``documents``. The sample SQL of the driver cannot say
the stages (models, hashes, Feistel networks), so ORACLE_SQL is None and tests/llm compare each stage
and the whole with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterstar.llm import decontam, mixing, ngram_join, pii, quality
from meterstar.llm.common import staged


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # learns from the texts of this stage's own input, the given labels, and no held-out id
    return quality.accepted(docs, quality.train(docs, _table(spark, sf_dir, "labels"), "quality"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_per_component(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminated(docs, _table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, keep=True).where("mix_taken > 0")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
