"""Files that tasks write and read by byte ranges in the shared folder."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame

from cantora.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder, and read from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or an absolute path (file, hdfs, s3, ...)."""
    return fs.FileSystem.from_uri(uri)


def attempt_name(prefix: str) -> str:
    """A name that no other attempt of the same task uses."""
    return f"{prefix}-{uuid.uuid4().hex}"
