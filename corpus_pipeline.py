"""The corpus pipeline: documents go through the stages in order, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordflow.llm.stages import STAGES
from recordflow.operators.lookups import saved

# The toxicity and near-duplicate stages have no SQL form; tests/llm compares the rows with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
