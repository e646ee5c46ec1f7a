"""The corpus pipeline: five stages from raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, exact_dedup, near_dedup, packing, quality
from tidemark.llm.scratch import Scratch

STAGES = [
    ("quality", quality.stage),
    ("exact_dedup", exact_dedup.stage),
    ("near_dedup", near_dedup.stage),
    ("decontamination", decontaminate.stage),
    ("packing", packing.stage),
]

#: Neither a trained classifier nor greedy packing can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
