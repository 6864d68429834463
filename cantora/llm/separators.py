"""Token counts from flat token files without an index.

A file is a run of little-endian unsigned 16-bit ids in which a separator ends
each document. Tasks read blocks of fixed size by their byte range and search
them for the separator in one vectorised comparison; a document that began in
an earlier block is stitched by a prefix scan over the blocks' summaries (how
many separators, and where the last one stood)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cantora.llm.files import attempt_name, store
from cantora.llm.tokens import Encoder
from cantora.session import ensure_checkpoint_dir

SEPARATOR = 50256
BLOCK_TOKENS = 2 << 20
WIDTH = 2


def write_flat(docs: DataFrame, tokenizer: str, root: str, separator: int = SEPARATOR) -> DataFrame:
    """Stand-in input: the documents' ids, each document closed by the separator, in one
    flat file a partition. Returns the files: (file, tokens), and nothing about documents.

    Null text is empty. A task's attempt writes a file of its own name; only
    those that the saved table lists are read."""
    schema = pa.schema([("part", pa.int32()), ("file", pa.string()), ("tokens", pa.int64())])

    def work(batches):
        from pyspark import TaskContext
        encoder, (files, path) = Encoder(tokenizer), store(root)
        part, n = TaskContext.get().partitionId(), 0
        name = attempt_name(f"tokens-{part:06d}")
        with files.open_output_stream(f"{path}/{name}", compression=None) as out:
            for batch in batches:
                for ids in encoder.each(batch.column(0)):
                    out.write(np.append(ids, separator).astype("<u2").tobytes())
                    n += len(ids) + 1
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([n], pa.int64())], schema=schema)

    files, path = store(root)
    files.create_dir(path, recursive=True)
    listed = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(work, "part int, file string, tokens long")
    listed.write.parquet(f"{root}/listed")
    return docs.sparkSession.read.parquet(f"{root}/listed")


def _scan(root: str, separator: int):
    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("k", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()), ("seps", pa.int64()), ("last", pa.int64())])

    def work(batches):
        files, path = store(root)
        for batch in batches:
            for part, name, block, at, n in zip(*(c.to_pylist() for c in batch.columns)):
                with files.open_input_file(f"{path}/{name}") as f:
                    ids = np.frombuffer(f.read_at(n * WIDTH, at * WIDTH), "<u2")
                found = np.flatnonzero(ids == separator) + at
                m = len(found)
                # k = -1: the block's summary; k >= 0: its separators, of which the first one's document may begin earlier
                begin = np.concatenate(([0], found + 1))[:m]
                first = np.zeros(m, bool)
                first[:1] = True
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(m + 1, part, np.int32)), pa.array(np.full(m + 1, block, np.int64)), pa.array(np.arange(-1, m)),
                    pa.array(np.append(0, begin), pa.int64(), mask=np.append(True, first)), pa.array(np.append(at + n, found), pa.int64()),
                    pa.array(np.append(m, np.zeros(m, np.int64)), pa.int64(), mask=np.append(False, np.ones(m, bool))),
                    pa.array(np.append(found[-1] if m else 0, np.zeros(m, np.int64)), pa.int64(), mask=np.append(m == 0, np.ones(m, bool)))], schema=schema)
    return work


def count_tokens(spark: SparkSession, listed: DataFrame, root: str, separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row a document: part (the file's number), doc_no (its place in the file,
    from 0), start, n_tokens (without the separator), terminated.

    Tokens after a file's last separator are a document that is not terminated;
    files without tokens, and empty tables, give no rows; files of one part
    number must not repeat. A document may span any number of blocks."""
    ensure_checkpoint_dir(spark)
    blocks = listed.where("tokens > 0").select("part", "file", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tokens") - 1, F.lit(block_tokens).cast("long"))).alias("at"))
    blocks = blocks.select("part", "file", F.floor(F.col("at") / block_tokens).alias("block"), "at", F.least(F.col("tokens") - F.col("at"), F.lit(block_tokens)).alias("n"))
    n = max(1, blocks.count())
    types = "part int, block long, k long, begin long, end long, seps long, last long"
    found = blocks.repartition(n, "part", "block").mapInArrow(_scan(root, separator), types).checkpoint()
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    summary = found.where("k < 0").select(
        "part", "block", F.col("end").alias("stop"), F.col("seps"), F.coalesce(F.last("last", True).over(before) + 1, F.lit(0)).alias("carry"),
        F.coalesce(F.sum("seps").over(before), F.lit(0)).alias("base"), "last",
        F.lead("block").over(Window.partitionBy("part").orderBy("block")).isNull().alias("final"))
    docs = found.where("k >= 0").join(summary.select("part", "block", "carry", "base"), ["part", "block"]).select(
        "part", (F.col("base") + F.col("k")).alias("doc_no"), F.coalesce("begin", "carry").alias("start"),
        (F.col("end") - F.coalesce("begin", "carry")).alias("n_tokens"), F.lit(True).alias("terminated"))
    begun = F.coalesce(F.col("last") + 1, F.col("carry"))
    rest = summary.where(F.col("final") & (F.col("stop") > begun)).select(
        "part", (F.col("base") + F.col("seps")).alias("doc_no"), begun.alias("start"), (F.col("stop") - begun).alias("n_tokens"), F.lit(False).alias("terminated"))
    return docs.unionByName(rest)
