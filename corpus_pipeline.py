"""Corpus pipeline over `documents`: stages of (name, function), each written as Parquet and read again."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assetscan.llm.common import stage_table
from assetscan.llm.pipeline import STAGES
from assetscan.session import ship_package

ORACLE_SQL = None  # the stages' models and text edits are not expressible in SQL; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to `documents`; each works on all rows its predecessor kept."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage_table(docs, f"stage{i}")
    return docs
