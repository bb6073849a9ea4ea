"""The corpus pipeline: toxicity, quality rules, near-duplicates, benchmark decontamination, packing.

Each stage takes what its predecessor kept, written as Parquet and read again, and returns the columns of documents; the
last one returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, packing, quality, simhash, toxicity
from tidemark.llm.common import read
from tidemark.llm.queries import packed
from tidemark.session import scratch_dir


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from all labels."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or whose posterior quality is low go."""
    return quality.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates, about 0.8 alike in five-word shingles, the document with the smallest id stays."""
    return simhash.keep_one_similar(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go."""
    return decontamination.keep_uncontaminated(docs, read(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens."""
    return packed(packing.pack(docs))


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality rules", quality_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# trained models and tokenizers are beyond SQL; tests hold the stages against brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
