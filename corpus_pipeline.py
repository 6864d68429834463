"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cantora.llm.stages import ORACLE_SQL, STAGES, run_stages  # noqa: F401


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents`` and return the last stage's rows."""
    return run_stages(spark, sf_dir)
