"""Corpus pipeline: quality rules, near-duplicates, personal data, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallycast.llm.mixing import mixing_stage
from tallycast.llm.near_dedup import near_dedup_stage
from tallycast.llm.personal_data import personal_data_stage
from tallycast.llm.piece_coding import encoding_stage
from tallycast.llm.quality_rules import quality_stage
from tallycast.session import work_path

STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("personal_data", personal_data_stage),
    ("mixing", mixing_stage),
    ("piece_coding", encoding_stage),
]

#: Near-duplicates and learned statistics have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    folder = work_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
