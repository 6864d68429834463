"""Exact removal of repeated byte strings with a logarithmic family of sparse suffix arrays.

A window of ``length`` bytes is anchored at the place in it whose ``gram`` bytes
have the least hash; equal windows have the same anchor in the same place. The
suffixes that begin at anchors (about 2 in ``length``) make a sparse suffix
array: a table sorted by the suffixes' first ``gram`` bytes, with how often and
where each occurs. Documents are indexed in batches: a batch's array is
merge-scanned against itself and every existing level, and two levels of equal
size are merged into one, so an entry is rewritten a logarithmic number of
times. What the scans return are the prefixes that occur twice or more.

Windows at such anchors are then compared whole: those at one prefix are
hashed at every offset, all in one pass, and the ones that occur again give the
bytes to remove. Equal contexts are counted before that, so that a passage or a
text in very many documents is compared once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantora.llm.arrays import Piece, column_batches, mix, pieces, prefix_hash, sliding_min, span_hash
from cantora.llm.bits import bit_table, maybe_in
from cantora.session import ensure_checkpoint_dir, scratch_path

LENGTH, GRAM, BATCHES = 400, 32, 4
_WINDOWS = 1 << 19   # windows hashed at once
_U = np.uint64


def anchors(p: Piece, length: int, gram: int):
    """(row, anchor, first window, last window, H, gram hash of each) in the piece's bytes."""
    n = len(p.data)
    h = prefix_hash(p.data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, h, np.zeros(0, _U)
    at = np.arange(n - gram + 1)
    grams = span_hash(h, at, at + gram)
    low = max(21, int(n).bit_length())
    best = sliding_min((grams & ~_U((1 << low) - 1)) | at.astype(_U), length - gram + 1) & _U((1 << low) - 1)
    rows = np.repeat(np.arange(len(p.offsets) - 1), np.diff(p.offsets))
    begin = np.flatnonzero(rows[:n - length + 1] == rows[length - 1:])   # windows within one document
    best = best[begin].astype(np.int64)
    if not len(begin):
        return none, none, none, none, h, np.zeros(0, _U)
    cut = np.flatnonzero((np.diff(best) != 0) | (np.diff(begin) != 1)) + 1
    first, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(begin)])) - 1
    c = best[first]
    return rows[c], c, begin[first], begin[last], h, grams[c]


def _binary(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte spans as a binary column."""
    size = end - start
    offsets = np.concatenate(([0], np.cumsum(size)))
    at = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at])]).cast(pa.binary())


def _entries(schema: pa.Schema, length: int, gram: int):
    def work(batch):
        for p in pieces(batch.column(1)):
            row, c, _, _, _, hashed = anchors(p, length, gram)
            _, one, many = np.unique(hashed, return_index=True, return_counts=True)   # a periodic text has one at each byte
            row, c = row[one], c[one]
            if len(c):
                yield _binary(p.data, c, c + gram), batch.column(0).take(pa.array(p.first + row)), c - p.offsets[row], many
    return lambda batches: column_batches(batches, schema, work)


class Index:
    """Levels of sorted suffix prefixes; the i-th holds a batch's worth times a power of two."""

    def __init__(self, spark, length: int = LENGTH, gram: int = GRAM):
        self.spark, self.length, self.gram = spark, length, gram
        self.levels: list[tuple[int, DataFrame]] = []

    def _store(self, entries: DataFrame) -> DataFrame:
        one = entries.groupBy("prefix").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
        path = scratch_path(self.spark, "suffixes")
        one.sortWithinPartitions("prefix").write.parquet(path)
        return self.spark.read.parquet(path)

    def add(self, texts: DataFrame) -> DataFrame:
        """Index ``texts`` (key, text) as the next batch; returns the prefixes that occur
        again, within the batch or in a level before it."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, a), (_, b) = self.levels.pop(), self.levels.pop()
            self.levels.append((2 * size, self._store(a.unionByName(b))))
        schema = pa.schema([("prefix", pa.binary()), ("key", pa.binary()), ("at", pa.int64()), ("n", pa.int64())])
        found = texts.select("key", "text").mapInArrow(_entries(schema, self.length, self.gram), "prefix binary, key binary, at long, n long")
        new = self._store(found.select("prefix", "n", F.struct("key", "at").alias("first")))
        again = new.where("n > 1").select("prefix")
        for _, level in self.levels:
            again = again.unionByName(new.select("prefix").join(level.select("prefix"), "prefix"))
        self.levels.append((1, new))
        path = scratch_path(self.spark, "again")
        again.write.parquet(path)
        return self.spark.read.parquet(path)


def _contexts(schema: pa.Schema, length: int, gram: int, sent, places: bool):
    """(anchor, context hash) of the windows at anchors that may repeat: with each one's
    place, or else once a piece with the bytes and how often they stand in it."""
    def work(batch):
        for p in pieces(batch.column(1)):
            row, c, s1, s2, h, hashed = anchors(p, length, gram)
            ok = maybe_in(sent.value, hashed)
            row, c, s1, s2, hashed = row[ok], c[ok], s1[ok], s2[ok], hashed[ok]
            whole = mix(span_hash(h, s1, s2 + length) + (c - s1).astype(_U) * _U(0x9E3779B97F4A7C15) + (s2 - s1).astype(_U))
            if places:
                yield hashed.view(np.int64), whole.view(np.int64), batch.column(0).take(pa.array(p.first + row)), s1 - p.offsets[row]
                continue
            _, one, many = np.unique(mix(hashed) ^ whole, return_index=True, return_counts=True)
            c, s1, s2 = c[one], s1[one], s2[one]
            for k in range(0, len(one), 4096):
                i = slice(k, k + 4096)
                yield (hashed[one][i].view(np.int64), whole[one][i].view(np.int64), (c - s1)[i], (s2 - s1)[i], many[i], _binary(p.data, s1[i], s2[i] + length))
    return lambda batches: column_batches(batches, schema, work)


def _repeated(group: np.ndarray, left: np.ndarray, more: np.ndarray, many: np.ndarray, data: np.ndarray, start: np.ndarray, length: int):
    """(context, first, last) of the maximal runs of repeated windows. Context i has
    windows start[i] + 0..more[i]; window k has its anchor left[i] - k bytes in.
    Windows are compared at one offset of the anchor after another, in blocks of offsets."""
    h = prefix_hash(data)
    low, high = int((left - more).min()), int(left.max())
    step = max(1, _WINDOWS // max(1, len(group)))
    who, where = [], []
    for a in range(low, high + 1, step):
        begin, end = np.maximum(left - np.minimum(left, a + step - 1), 0), np.minimum(left - a, more)
        n = np.maximum(end - begin + 1, 0)
        i = np.repeat(np.arange(len(group)), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + begin[i]
        value = mix(span_hash(h, start[i] + k, start[i] + k + length) ^ mix(group[i] + (left[i] - k).astype(_U) * _U(0xD6E8FEB86659FD93)))
        _, inverse, count = np.unique(value, return_inverse=True, return_counts=True)
        twice = (count[inverse] > 1) | (many[i] > 1)
        who.append(i[twice])
        where.append(k[twice])
    who, where = np.concatenate(who), np.concatenate(where)
    order = np.lexsort((where, who))
    who, where = who[order], where[order]
    if not len(who):
        return who, who, who
    cut = np.flatnonzero((np.diff(who) != 0) | (np.diff(where) != 1)) + 1
    first, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(who)])) - 1
    return who[first], where[first], where[last]


def _compare(schema: pa.Schema, length: int):
    """Over contexts sorted by anchor: whole anchors at a time, several in one pass."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def flush(t: pa.Table):
            t = t.combine_chunks()
            if not t.num_rows:
                return
            group, whole, left, more, many = (t.column(c).to_numpy() for c in ("anchor", "whole", "c", "more", "many"))
            text = t.column("context").chunk(0).cast(pa.large_binary())
            offs = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
            data = np.frombuffer(text.buffers()[2], np.uint8)[offs[0]:offs[-1]]
            i, a, b = _repeated(group.view(_U), left, more, many, data, offs[:-1] - offs[0], length)
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(group[i]), pa.array(whole[i]), pa.array(a), pa.array(b + length)], schema=schema)

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            g = t.column("anchor").to_numpy()
            n = int(np.searchsorted(g, g[-1], side="left"))   # the last anchor may go on in the next batch
            yield from flush(t.slice(0, n))
            held = t.slice(n)
        if held is not None:
            yield from flush(held)
    return work


def _merged(spans: list) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _cut(schema: pa.Schema, with_text: bool):
    def work(batch):
        cols = [[] for _ in schema]
        for doc, text, spans in zip(batch.column(0), batch.column(1), batch.column(2)):
            doc, data = doc.as_py(), (text.as_py() or "").encode()
            gone = _merged([(x["a"], x["b"]) for x in spans.as_py() or ()])
            kept, at = [], 0
            for a, b in gone:
                kept.append(data[at:a])
                at = b
            kept = b"".join([*kept, data[at:]])
            for c, v in zip(cols, (doc, len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept if with_text else None)):
                c.append(v)
        yield tuple(cols)
    return lambda batches: column_batches(batches, schema, work)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES, with_text: bool = False) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the
    remaining bytes, if ``with_text``).

    Removed is each byte covered by a string of ``length`` bytes that also starts
    anywhere else in the input, as it was given. Defined results: null text is
    empty; repeated rows are documents of their own, so what they share goes from
    each of them; rows without doc_id take part; columns but doc_id and text are
    not read; an empty table gives no rows. Documents are whole and of any size;
    matches don't cross them."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.unhex(F.md5("text")))
    long = rows.where(F.octet_length("text") >= length)
    index, again = Index(spark, length, gram), None
    for k in range(batches):
        part = index.add(long.where(F.pmod(F.xxhash64("text"), F.lit(batches)) == k))
        again = part if again is None else again.unionByName(part)

    # the hash of a prefix, as ``anchors`` has it, for the filter and the join
    def prefix_hashes(batch):
        text = batch.column(0).cast(pa.large_binary())
        offs = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2], np.uint8)[offs[0]:offs[-1]]
        yield (span_hash(prefix_hash(data), offs[:-1] - offs[0], offs[1:] - offs[0]).view(np.int64),)

    one = pa.schema([("anchor", pa.int64())])
    hashed = again.mapInArrow(lambda b: column_batches(b, one, prefix_hashes), "anchor long").distinct().checkpoint()
    sent = spark.sparkContext.broadcast(bit_table(hashed, "anchor"))
    schema = pa.schema([("anchor", pa.int64()), ("whole", pa.int64()), ("c", pa.int64()), ("more", pa.int64()), ("many", pa.int64()), ("context", pa.binary())])
    found = long.select("key", "text").mapInArrow(_contexts(schema, length, gram, sent, False), "anchor long, whole long, c long, more long, many long, context binary")
    kinds = found.groupBy("anchor", "whole").agg(F.sum("many").alias("many"), F.first("c").alias("c"), F.first("more").alias("more"), F.first("context").alias("context"))
    kinds = kinds.repartition("anchor").sortWithinPartitions("anchor")
    schema = pa.schema([("anchor", pa.int64()), ("whole", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
    runs = kinds.select("anchor", "whole", "c", "more", "many", "context").mapInArrow(_compare(schema, length), "anchor long, whole long, a long, b long")
    schema = pa.schema([("anchor", pa.int64()), ("whole", pa.int64()), ("key", pa.binary()), ("s1", pa.int64())])
    places = long.select("key", "text").mapInArrow(_contexts(schema, length, gram, sent, True), "anchor long, whole long, key binary, s1 long").distinct()
    spans = places.join(runs, ["anchor", "whole"]).select("key", (F.col("s1") + F.col("a")).alias("a"), (F.col("s1") + F.col("b")).alias("b"))
    gone = spans.groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("spans")).checkpoint()

    # only texts that may have spans are shuffled to them
    sent_keys = spark.sparkContext.broadcast(bit_table(gone.select(F.xxhash64("key").alias("h")), "h"))

    def touched(want: bool):
        def work(batches):
            for batch in batches:
                hit = maybe_in(sent_keys.value, batch.column("h").to_numpy().view(_U))
                yield batch.filter(pa.array(hit if want else ~hit))
        return work

    tagged = rows.withColumn("h", F.xxhash64("key"))
    out_schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
    near = tagged.mapInArrow(touched(True), tagged.schema).join(gone, "key", "left").select("doc_id", "text", "spans")
    types = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    cut = _cut(out_schema, with_text)
    far = tagged.select("doc_id", "text", F.lit(None).cast("array<struct<a:long,b:long>>").alias("spans"), "h")
    out = far.mapInArrow(lambda batches: cut(touched(False)(batches)), types).unionByName(near.mapInArrow(cut, types))
    return out if with_text else out.drop("kept")
