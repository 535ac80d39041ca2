"""The corpus pipeline: quality rules, exact dedup, near dedup, secret masking, packing.

Every stage but the last returns the columns of `documents`; each is written as Parquet and read
again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from beatloom.llm import exact_dedup, jaccard_join, packing, quality_rules, secret_scan
from beatloom.llm.shared import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays."""
    return jaccard_join.drop_near_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in them are masked."""
    return secret_scan.mask_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its sequence and place."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("jaccard_join", near),
    ("secret_scan", secrets),
    ("best_fit_packing", pack),
]

# Tokens come from a tokenizer library, which SQL cannot call.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
