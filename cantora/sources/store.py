"""Versioned tables in the shared folder.

A table is a set of *parts* (a month, a batch, or the whole table), each a
folder of Parquet files that is never changed once written. A version is a
manifest, one small JSON file that names the folders of its parts::

    <root>/data/build=<id>/part=<value>/part-*.parquet
    <root>/manifests/00000007.json

A commit puts the next manifest under its number, in one step that fails if the
number is taken (a hard link locally, a rename without overwriting elsewhere).
Readers open one manifest and see that version whole, whatever is written
meanwhile; a writer that loses the race reads the winner's version and tries
again (``update``). Executors only write data; the driver handles manifests,
whose size is the number of parts, not of files or rows.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time
import uuid
import zlib
from collections.abc import Callable
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PART = "part"
WHOLE = "all"


class LostRace(RuntimeError):
    """Another writer took every version number that this one tried."""


# ------------------------------------------------------------ shared file system
def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, modification time) of the data files under ``path``, in order; none if it is missing."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return []
    out, it = [], fs.listFiles(p, True)
    while it.hasNext():
        s = it.next()
        name = s.getPath().getName()
        if not name.startswith(("_", ".")):
            out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return sorted(out)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text`` whole, or return False if it is there already."""
    fs, p = _hadoop(spark, path)
    fs.mkdirs(p.getParent())
    tmp = f"{os.path.dirname(path)}/.tmp-{uuid.uuid4().hex}"
    if urlparse(path).scheme in ("", "file"):
        local, target = urlparse(tmp).path, urlparse(path).path
        with open(local, "w") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(local, target)       # atomic, fails if the target exists
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(local)
    _, t = _hadoop(spark, tmp)
    stream = fs.create(t, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    # an ordinary rename takes no options here: it refuses a target that exists
    done = not fs.exists(p) and fs.rename(t, p)
    if not done:
        fs.delete(t, False)
    return done


# ----------------------------------------------------------------------- tables
class Store:
    """One versioned table under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # reading
    def version(self) -> int:
        """Number of the newest version; 0 before the first."""
        fs, p = _hadoop(self.spark, f"{self.root}/manifests")
        if not fs.exists(p):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def manifest(self, version: int | None = None) -> dict | None:
        v = self.version() if version is None else version
        return json.loads(read_text(self.spark, f"{self.root}/manifests/{v:08d}.json")) if v else None

    def read(self, manifest: dict | None = None, parts: list[str] | None = None) -> DataFrame:
        """The rows of one version (the newest unless given), or of some of its parts."""
        m = manifest or self.manifest()
        if m is None:
            raise FileNotFoundError(f"nothing is published under {self.root}")
        schema = StructType.fromJson(m["schema"])
        paths = [f"{self.root}/{p}" for k, p in sorted(m["parts"].items()) if parts is None or k in parts]
        if not paths:
            return self.spark.createDataFrame([], schema)
        # folder names are not columns: the data has all it needs
        return self.spark.read.schema(schema).parquet(*paths)

    # writing
    def write(self, df: DataFrame, part: Column | None = None) -> dict:
        """Write ``df`` to a new folder, one sub-folder a value of ``part``; returns
        {"schema", "parts"}. Large parts get several files, small ones one (rebalanced)."""
        folder = f"data/build={uuid.uuid4().hex[:16]}"
        path = f"{self.root}/{folder}"
        schema = json.loads(df.schema.json())
        if part is None:
            df.write.parquet(path)
            return {"schema": schema, "parts": {WHOLE: folder}}
        df.withColumn(PART, part.cast("string")).hint("rebalance", PART).write.partitionBy(PART).parquet(path)
        fs, p = _hadoop(self.spark, path)
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        return {"schema": schema, "parts": {n.split("=", 1)[1]: f"{folder}/{n}" for n in names if n.startswith(f"{PART}=")}}

    def commit(self, base: int, manifest: dict) -> bool:
        """Publish ``manifest`` as version ``base`` + 1; False if another writer was first."""
        text = json.dumps({**manifest, "version": base + 1}, sort_keys=True)
        return put_new(self.spark, f"{self.root}/manifests/{base + 1:08d}.json", text)

    def update(self, change: Callable[[dict | None], dict | None], attempts: int = 50) -> dict | None:
        """Compare-and-swap: ``change`` gets the newest manifest and returns the next one
        (None: nothing to do), again for each race lost. Returns what is current at the end."""
        for k in range(attempts):
            base = self.version()
            old = self.manifest(base)
            new = change(old)
            if new is None:
                return old
            if self.commit(base, new):
                return self.manifest(base + 1)
            time.sleep(0.01 * (k + 1))
        raise LostRace(f"{self.root}: {attempts} commits lost")


def spread(part: dict, old: dict | None, touched: list[str] | None) -> dict:
    """The parts of the next version: those just written, and the old ones not touched."""
    kept = {} if touched is None or old is None else {k: p for k, p in old["parts"].items() if k not in touched}
    return {**kept, **part["parts"]}


# ------------------------------------------------------------------- publishing
def month_of(date: Column) -> Column:
    """Name of a date's month; rows without a date have a part of their own."""
    return F.coalesce(F.date_format(F.trunc(date, "month"), "yyyy-MM-dd"), F.lit("none"))


def _fingerprint(spark: SparkSession, path: str) -> list[int]:
    """Files, bytes, newest time and a sum of hashes over names, sizes and times."""
    files = list_files(spark, path)
    mark = sum(zlib.crc32(f"{os.path.basename(n)}|{size}|{t}".encode()) * (size + 1) for n, size, t in files)
    return [len(files), sum(s for _, s, _ in files), max((t for *_, t in files), default=0), mark % (1 << 61)]


def _file_key() -> list[Column]:
    return [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"), F.col("_metadata.file_modification_time").alias("time")]


def _file_months(df: DataFrame, date: str) -> DataFrame:
    """path, bytes, time and months (sorted) of every data file of a scan."""
    rows = df.select(*_file_key(), F.trunc(F.col(date).cast("date"), "month").alias("month")).distinct()
    return rows.groupBy("path", "bytes", "time").agg(F.array_sort(F.collect_set(month_of(F.col("month")))).alias("months"))


def _touched(spark: SparkSession, driving: str, date: str, known: DataFrame) -> tuple[list[str], DataFrame]:
    """Months of the files of ``driving`` that came, went or changed since ``known``, and
    the file table as it is now. The listing opens no file; only new and changed ones are read."""
    now = spark.read.format("binaryFile").load(driving).select(*_file_key())
    same = ["path", "bytes", "time"]
    fresh = [r.path for r in now.join(known, same, "left_anti").select("path").collect()]
    kept, gone = known.join(now, same, "left_semi"), known.join(now, same, "left_anti")
    new = _file_months(spark.read.parquet(*fresh), date) if fresh else known.limit(0)
    months = gone.select("months").unionByName(new.select("months")).select(F.explode("months").alias("m")).distinct()
    return sorted(r.m for r in months.collect()), kept.unionByName(new)


def publish(store: Store, driving: str, date: str, lookups: list[str], build: Callable[[list[str] | None], DataFrame], month: str) -> dict:
    """Bring ``store`` up to date with its input files and return its manifest.

    ``driving`` is the folder or file whose rows carry the column ``date``; ``build``
    makes the table's rows of some months (None: of all) and ``month`` names
    their date column. Unchanged inputs: nothing is read or written. Files of
    ``driving`` added, removed or rewritten: only the months they hold, or held, are
    built and replaced. A change in a lookup: all months are."""
    spark = store.spark

    def change(old: dict | None) -> dict | None:
        marks = {p: _fingerprint(spark, p) for p in [driving, *lookups]}
        if old and old["inputs"] == marks:
            return None
        touched, files = None, None
        if old and all(old["inputs"].get(p) == marks[p] for p in lookups):
            touched, files = _touched(spark, driving, date, spark.read.parquet(f"{store.root}/{old['files']}"))
        if files is None:
            files = _file_months(spark.read.parquet(driving), date)
        folder = f"files/{uuid.uuid4().hex[:16]}"
        files.write.parquet(f"{store.root}/{folder}")
        wrote = store.write(build(touched), month_of(F.col(month)))
        return {"schema": wrote["schema"], "parts": spread(wrote, old, touched), "inputs": marks, "files": folder, "touched": touched}

    return store.update(change)


def derive(store: Store, upstream: dict, build: Callable[[list[str] | None], DataFrame], month: Callable[[], Column], later: bool = False) -> dict:
    """Bring ``store`` up to date with ``upstream``, the manifest of a table in months:
    the months whose folder is another one are rebuilt (with ``later``, all from the
    first of them on: what looks back at earlier rows). Unchanged: nothing is done."""
    def change(old: dict | None) -> dict | None:
        if old and old["upstream"] == upstream["parts"]:
            return None
        touched = None
        if old:
            a, b = old["upstream"], upstream["parts"]
            touched = sorted(k for k in {*a, *b} if a.get(k) != b.get(k))
            if later and touched:
                touched = sorted(k for k in {*a, *b, *old["parts"]} if k >= touched[0])
        wrote = store.write(build(touched), month())
        return {"schema": wrote["schema"], "parts": spread(wrote, old, touched), "upstream": upstream["parts"], "touched": touched}

    return store.update(change)


def publish_whole(store: Store, inputs: list[str], build: Callable[[], DataFrame]) -> dict:
    """Bring an undivided table up to date with its input files: rebuilt if any changed."""
    def change(old: dict | None) -> dict | None:
        marks = {p: _fingerprint(store.spark, p) for p in inputs}
        if old and old["inputs"] == marks:
            return None
        return {**store.write(build()), "inputs": marks}

    return store.update(change)


# ------------------------------------------------------------------ batch ledger
LEDGER = "table_name string, batch_id string, source_file string, n_rows long, raw_ingest_ts timestamp_ntz"


def land_batch(store: Store, batch_id: str, build: Callable[[], DataFrame], source_file: str, replace: bool = False) -> dict:
    """Land one batch in a raw table, once: its rows and its row in the ledger are
    published by the same commit, so a rerun of a landed batch does nothing and a
    failed one leaves nothing. ``build`` gives the rows with their ``raw_ingest_ts``;
    with ``replace`` they take the place of all earlier batches' rows (truncate and
    load), whose ledger rows stay."""
    def change(old: dict | None) -> dict | None:
        ledger = old["ledger"] if old else []
        if any(b["batch_id"] == batch_id for b in ledger):
            return None
        wrote = store.write(build())
        folder = wrote["parts"][WHOLE]
        got = store.spark.read.schema(StructType.fromJson(wrote["schema"])).parquet(f"{store.root}/{folder}")
        r = got.agg(F.count(F.lit(1)).alias("n"), F.max("raw_ingest_ts").cast("string").alias("ts")).first()
        row = {"batch_id": batch_id, "source_file": source_file, "n_rows": r.n, "raw_ingest_ts": r.ts}
        parts = {} if replace or old is None else old["parts"]
        return {"schema": wrote["schema"], "parts": {**parts, f"{len(ledger):06d}": folder}, "ledger": [*ledger, row]}

    return store.update(change)


def ledger(spark: SparkSession, stores: dict[str, Store]) -> DataFrame:
    """All landed batches of the raw tables: one row a batch (their number, not their rows, reaches the driver)."""
    rows = []
    for name, s in stores.items():
        for b in (s.manifest() or {"ledger": []})["ledger"]:
            rows.append((name, b["batch_id"], b["source_file"], b["n_rows"], dt.datetime.fromisoformat(b["raw_ingest_ts"]) if b["raw_ingest_ts"] else None))
    return spark.createDataFrame(rows, LEDGER)
