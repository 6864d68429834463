"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and works on
all rows its predecessor kept; all but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantora.llm import decontaminate, packing, pii, quality
from cantora.llm.minhash import near_duplicates
from cantora.llm.queries import table, tokenizer_path
from cantora.session import scratch_path

#: packed sequences, and spans that a trained model adds, have no SQL form
ORACLE_SQL = None
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; null and empty texts are among them."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8) stays: the one of smallest doc_id.
    Rows without doc_id stay; rows that repeat a doc_id share its verdict."""
    gone = near_duplicates(docs, percent=NEAR_PERCENT).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item, in any order, go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the text; every row stays."""
    return pii.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents packed into sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("personal_data", personal_data), ("pack", pack)]


def run_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage's result is written as Parquet in the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
