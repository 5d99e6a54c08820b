"""Corpus pipeline: quality rules, near-duplicates, repeated passages, mixing
and packing.  Each stage takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next stage's documents."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession

from tessera.llm import minhash, mixing, packing, queries, rules, suffix
from tessera.session import scratch_folder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    queries.prepare(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return rules.kept_documents(docs, labels)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates."""
    queries.prepare(spark)
    return minhash.deduplicated(docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that repeat."""
    queries.prepare(spark)
    return suffix.cleaned_documents(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources as documents: whole texts for whole passes, and
    the words that the last pass took."""
    queries.prepare(spark)
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 1024 tokens."""
    queries.prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Learned rules and token ids cannot be stated in SQL; tests/llm holds each
#: stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    top = scratch_folder(spark, "pipeline")  # goes when the program ends
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{k}_{name}")
        docs = spark.read.parquet(f"{top}/{k}_{name}")
    return docs
