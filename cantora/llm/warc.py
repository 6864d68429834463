"""Deterministic sharded WARC writer and reader.

Pages are dealt to shards by ranges of (page_id, digest) that hold about equal payload
bytes, found by an exact prefix sum over the sorted pages, sorted within a shard, and written as gzip members, one a record, into
files that roll at a compressed size. Everything in a file follows from the
pages and the parameters, so a rewrite gives the same bytes. Tasks write under
names of their own attempt and report them; the table of reported files is
saved, each file is renamed from it (again after a failure, without harm), and
the renamed manifest is the commit: a reader sees listed files only."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cantora.llm.files import attempt_name, store
from cantora.session import ensure_checkpoint_dir

SHARD_BYTES = 64 << 20
ROLL_BYTES = 16 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_REPORT = "shard int, seq int, attempt string, file string, records long, bytes long"
_SENT = "page_id long, sha1 binary, content boolean, refers_to long, url string, html string"
_RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def _b32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    name = urn[len("<urn:page:"):-1]
    return None if name == "none" else int(name)


def record(page_id: int | None, url: str | None, payload: bytes, sha1: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One WARC record; a revisit has the HTTP header of the payload but not the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[%\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines += [f"WARC-Payload-Digest: sha1:{_b32(sha1)}", f"WARC-Block-Digest: sha1:{_b32(hashlib.sha1(block).digest())}"]
    if revisit:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class _Roller:
    """Writes members of one shard into files of at most ``roll`` bytes, or one member."""

    def __init__(self, root: str, shard: int, roll: int):
        self.fs, self.path = store(root)
        self.shard, self.roll, self.seq, self.out = shard, roll, 0, None
        self.reports: list[tuple] = []

    def add(self, member: bytes) -> None:
        if self.out is not None and self.size + len(member) > self.roll:
            self.close()
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.seq:06d}.warc.gz"
            self.attempt = f"_attempts/{attempt_name(self.name)}"
            self.out, self.size, self.records = self.fs.open_output_stream(f"{self.path}/{self.attempt}", compression=None), 0, 0
        self.out.write(member)
        self.size += len(member)
        self.records += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.reports.append((self.shard, self.seq, self.attempt, self.name, self.records, self.size))
            self.seq, self.out = self.seq + 1, None


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def _place(page_id: Column, sha1: Column) -> Column:
    """29 bytes that sort as (page_id, nulls first; sha1)."""
    number = F.lpad(F.hex(page_id.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.concat(F.unhex(F.concat(F.when(page_id.isNull(), "00").otherwise("01"), F.coalesce(number, F.lit("0" * 16)))), sha1)


def _borders(rows: DataFrame, shard_bytes: int) -> np.ndarray:
    """The first place of every shard, ascending: a place is in the shard in which the
    bytes of all places before it end. They follow from the rows alone.

    Places are summed, range-partitioned and sorted; the sums of the partitions (a row
    each) come to the driver, and the borders, 29 bytes for each ``shard_bytes`` of pages."""
    ensure_checkpoint_dir(rows.sparkSession)
    size = F.octet_length(F.coalesce("html", F.lit(""))) + 512
    places = rows.groupBy(_place(F.col("page_id"), F.col("sha1")).alias("place")).agg(F.sum(size).alias("bytes"))
    places = places.repartitionByRange("place").sortWithinPartitions("place").withColumn("part", F.spark_partition_id()).checkpoint()
    bases, total = {}, 0
    for part, n in sorted(tuple(r) for r in places.groupBy("part").agg(F.sum("bytes")).collect()):
        bases[part], total = total, total + n
    schema = pa.schema([("shard", pa.int64()), ("place", pa.binary())])

    def firsts(batches):
        before, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            size = batch.column("bytes").to_numpy()
            before = bases[batch.column("part")[0].as_py()] if before is None else before
            shard = (before + np.cumsum(size) - size) // shard_bytes
            before += int(size.sum())
            first = np.flatnonzero(np.diff(shard, prepend=-1 if last is None else last))
            last = shard[-1]
            yield pa.RecordBatch.from_arrays([pa.array(shard[first]), batch.column("place").take(pa.array(first))], schema=schema)

    found = places.mapInArrow(firsts, "shard long, place binary").groupBy("shard").agg(F.min("place").alias("place"))
    return np.array(sorted(bytes(r["place"]) for r in found.collect()), "S29")


def _dealer(borders):
    def work(batches):
        for batch in batches:
            place = np.array(batch.column(0).to_pylist(), "S29")
            shard = np.searchsorted(borders.value, place, side="right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *batch.columns[1:]], ["shard", *batch.schema.names[1:]])
    return work


def _writer(root: str, roll: int, date: str):
    schema = pa.schema([("shard", pa.int32()), ("seq", pa.int32()), ("attempt", pa.string()), ("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def work(batches):
        roller, refers = None, None
        for batch in batches:
            for shard, page_id, sha1, content, refers_to, url, html in zip(*batch.columns):
                if roller is None or roller.shard != shard.as_py():
                    if roller is not None:
                        roller.close()
                        yield _table(roller.reports, schema)
                    roller = _Roller(root, shard.as_py(), roll)
                page_id = page_id.as_py()
                if not content.as_py():  # precedes the rows of its page and payload
                    refers = refers_to.as_py()
                else:
                    payload = (html.as_py() or "").encode()
                    roller.add(_member(record(page_id, url.as_py(), payload, sha1.as_py(), refers, page_id != refers, date)))
        if roller is not None:
            roller.close()
            yield _table(roller.reports, schema)
    return work


def _renamer(root: str):
    def work(batches):
        files, path = store(root)
        for batch in batches:
            for attempt, name in zip(batch.column("attempt").to_pylist(), batch.column("file").to_pylist()):
                if files.get_file_info(f"{path}/{attempt}").type.name != "NotFound":
                    files.move(f"{path}/{attempt}", f"{path}/{name}")
            yield batch
    return work


def write_archives(pages: DataFrame, root: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, date: str = DATE) -> str:
    """Write ``pages`` (page_id, url, html) under ``root`` and return the manifest's path.

    Of rows with equal payloads that of the largest page_id is the response,
    the others revisits of it. Defined results: null html is an empty payload;
    a null url has no header; a null page_id sorts first and is the response
    only if no row of its payload has an id; rows that repeat a page_id and
    payload are of the same type; other columns are not read; an empty table
    gives an empty manifest."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("sha1", F.unhex(F.sha1(F.coalesce("html", F.lit("")))))
    borders = _borders(rows, shard_bytes)
    kept = rows.groupBy("sha1").agg(F.max("page_id").alias("kept"))
    thin = rows.select("page_id", "sha1").distinct().join(kept, "sha1")
    both = thin.select("page_id", "sha1", F.lit(False).alias("content"), F.col("kept").alias("refers_to"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"))
    both = both.unionByName(rows.select("page_id", "sha1", F.lit(True).alias("content"), F.lit(None).cast("long").alias("refers_to"), "url", "html"))
    both = both.select(_place(F.col("page_id"), F.col("sha1")).alias("place"), "page_id", "sha1", "content", "refers_to", "url", "html")
    both = both.mapInArrow(_dealer(spark.sparkContext.broadcast(borders)), f"shard int, {_SENT}")
    both = both.repartitionById(max(1, len(borders)), "shard").sortWithinPartitions("shard", "page_id", "sha1", "content", "url")

    files, path = store(root)
    files.create_dir(f"{path}/_attempts", recursive=True)
    both.mapInArrow(_writer(root, roll_bytes, date), _REPORT).write.parquet(f"{root}/_reported")
    reported = spark.read.parquet(f"{root}/_reported")
    reported.mapInArrow(_renamer(root), _REPORT).select("shard", "seq", "file", "records", "bytes").write.parquet(f"{root}/_renamed")
    files.move(f"{path}/_renamed", f"{path}/manifest")
    return f"{root}/manifest"


def parse(stream) -> "list[tuple]":
    """(page_id, url, type, refers_to, digest, payload_bytes, payload) of each record of a WARC stream; digests are checked."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[name] = value
        block = stream.read(int(head["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n" or "sha1:" + _b32(hashlib.sha1(block).digest()) != head["WARC-Block-Digest"]:
            raise ValueError(f"damaged record {head['WARC-Record-ID']}")
        http, _, payload = block.partition(b"\r\n\r\n")
        digest, revisit = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"] == "revisit"
        if not revisit and _b32(hashlib.sha1(payload).digest()) != digest:
            raise ValueError(f"damaged payload {head['WARC-Record-ID']}")
        url = head.get("WARC-Target-URI")
        yield (_page(head["WARC-Record-ID"]), url if url is None else re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url), head["WARC-Type"],
               _page(head["WARC-Refers-To"]) if revisit else None, digest, int(re.search(rb"Content-Length: (\d+)", http)[1]), None if revisit else payload)


def _reader(root: str, with_payload: bool):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def work(batches):
        files, path = store(root)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with gzip.GzipFile(fileobj=files.open_input_stream(f"{path}/{name}", compression=None)) as stream:
                    for r in parse(stream):
                        rows.append(r if with_payload else (*r[:-1], None))
                        held += len(r[-1] or b"") if with_payload else 64
                        if held > 4 << 20:
                            yield _table(rows, schema)
                            rows, held = [], 0
                yield _table(rows, schema)
    return work


def read_archives(spark: SparkSession, root: str, with_payload: bool = True) -> DataFrame:
    """The records of the listed files under ``root``, read as streams, a file a task."""
    manifest = spark.read.parquet(f"{root}/manifest").select("file")
    n = max(1, manifest.count())
    return manifest.repartition(n, "file").mapInArrow(_reader(root, with_payload), _RECORD)
