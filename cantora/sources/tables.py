"""Access to the driver's Parquet tables.

Reads are lazy; Catalyst prunes columns and pushes filters into the scan, so a
query that touches two columns of ``lineitem`` reads only those two."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A scan of what the path holds now; its splits are Spark's."""
    return spark.read.parquet(path)


class Tables:
    """``Tables(spark, sf_dir).lineitem`` -> DataFrame over the Parquet file."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return read_parquet(self.spark, f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            df = self.read(name)
            setattr(self, name, df)
            return df
        raise AttributeError(name)

    @cached_property
    def paths(self) -> dict[str, str]:
        return {t: f"{self.sf_dir}/{t}.parquet" for t in TABLE_NAMES}
