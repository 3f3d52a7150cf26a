"""Corpus preparation in stages; each reads what the one before it kept.

``run`` applies the stages to ``documents``. After each one the rows are written
as Parquet to the shared folder and read again, so that a lost executor costs one
stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import decontaminate, packing, pii, quality, simhash
from staylens.llm.shared import stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the smallest doc_id stays: texts whose SimHash differs in three
    bits at most, and texts whose five-word shingles have an exact similarity of 0.8."""
    return simhash.representatives(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; no document goes."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.coalesce(F.char_length("text").cast("bigint"), F.col("n_chars")))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence of at most 2048 tokens."""
    return packing.pack_texts(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("pack", pack_stage),
]

#: Learned models, components and tokenizers are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
