"""From raw documents to packed training sequences, in stages that each use one operator of `loanmill.llm`.

A stage takes all that its predecessor kept. All but the last return the columns of `documents`; the last returns the pieces of
the packed sequences. Empty tables, NULLs, repeated rows and further columns have the results that the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmill.llm import decontaminate, near_dedup, packing, pii, quality_rules
from loanmill.llm.common import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.without_rejected(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, similarity 0.8)."""
    return near_dedup.one_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_benchmarks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; `n_chars` counts the new text."""
    masked = pii.mask(docs)
    if "n_chars" not in docs.columns:
        return masked
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their token ids, in sequences of 2048 tokens."""
    return packing.pack(docs, keep_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", deduplicate),
    ("decontamination", without_benchmarks),
    ("pii", mask_personal_data),
    ("packing", pack),
]

# A language model, near-duplicate search, bootstrapping and packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
