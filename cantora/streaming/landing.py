"""Incremental raw landing with Structured Streaming.

The reference lands each batch file into a TEXT raw table with lineage
(source system, source file) and a default ingest time. Here every CSV batch
that appears in a landing folder is read as TEXT (no type inference: the raw
layer keeps cells as they came), stamped with its file name and the ingest
time, and appended to the raw table. The stream's checkpoint lives in the
shared checkpoint folder, so a restarted or re-run job lands each file exactly
once; ``availableNow`` processes what is there and stops (a scheduled load),
a processing-time trigger keeps landing as files arrive.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery



def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def land_stream(spark: SparkSession, source_dir: str, columns: list[str], target_dir: str,
                source_system: str = "erp", checkpoint: str | None = None,
                once: bool = True, files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the landing stream; returns the running query.

    The checkpoint belongs to the target: unless given, it is the folder beside
    it, so that a restart goes on where the last run stopped."""
    ckpt = checkpoint or f"{target_dir.rstrip('/')}.checkpoint"
    reader = spark.readStream.schema(text_schema(columns)).option("header", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    src = reader.csv(source_dir)
    out = src.select(*columns, F.lit(source_system).alias("source_system"),
                     F.col("_metadata.file_name").alias("source_file"),
                     F.current_timestamp().alias("raw_ingest_ts"))
    w = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", ckpt).option("path", target_dir))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")
    return w.start()
