"""Numbering rows within keys without gathering a key in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cantora.session import ensure_checkpoint_dir


def number_within(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... within each ``key``, without gaps.

    Rows are checkpointed, which fixes their partitions; each partition counts
    its rows of a key, the counts are summed over partitions, and a row's
    number is its place in its partition (by ``order``) after that sum. A key's
    rows thus stay spread over the partitions they came in."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.withColumn("_part", F.spark_partition_id()).checkpoint()
    counts = rows.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col(key).alias("_key"), F.col("_part").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    rows = rows.withColumn("_at", F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)) - 1)
    rows = rows.join(counts, rows[key].eqNullSafe(counts["_key"]) & (rows["_part"] == counts["_of"]))
    return rows.withColumn(name, (F.col("_base") + F.col("_at")).cast("long")).drop("_part", "_at", "_key", "_of", "_base")
