"""Best-fit packing of token sequences by exact-complement hashing.

Documents become token pieces of at most ``capacity``; a piece's length is all
that packing needs, so the plan is made on the histogram of lengths (at most
``capacity`` counts): combinations of two, three and four lengths that fill a
sequence exactly are found by looking up the complement of a length in the
index of single, pair and triple sums and consumed as often as their counts
allow; what is left is packed best fit decreasing. The pieces are then
numbered within their length, and the plan's intervals turn (length, number)
into a sequence and an offset inside Spark tasks."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantora.llm.arrays import column_batches
from cantora.llm.ranks import number_within
from cantora.llm.tokens import Encoder

CAPACITY = 2048


def exact_fills(count: list[int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """(lengths with repeats, times) of combinations that fill a sequence exactly; takes them off ``count``."""
    plan = []

    def take(*parts: int) -> None:
        need = {p: parts.count(p) for p in parts}
        times = min(count[p] // k for p, k in need.items())
        if times:
            for p, k in need.items():
                count[p] -= k * times
            plan.append((sorted(need.items(), reverse=True), times))

    take(capacity)
    for a in range(capacity - 1, (capacity - 1) // 2, -1):   # single sums: the complement of a
        if count[a] and count[capacity - a]:
            take(a, capacity - a)
    for a in range(capacity - 2, 0, -1):                       # pair sums
        gap = capacity - a
        for b in range(min(a, gap - 1), (gap - 1) // 2, -1):
            if not count[a]:
                break
            if count[b] and count[gap - b]:
                take(a, b, gap - b)
    for a in range(capacity - 3, 0, -1):                       # triple sums
        for b in range(min(a, capacity - a - 2), 0, -1):
            if not count[a]:
                break
            if not count[b]:
                continue
            gap = capacity - a - b
            if gap > 2 * b:
                break
            have = np.asarray(count[:gap], np.int64) > 0
            for c in np.flatnonzero(have & have[::-1][np.arange(-1, gap - 1)]).tolist() if gap > 1 else ():
                if c and c <= b and gap - c <= c:
                    take(a, b, c, gap - c)
    return plan


def best_fit_rest(count: list[int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best fit decreasing of what ``count`` still has, equal bins handled together."""
    bins: list[tuple[int, int]] = []  # (gap, id), sorted
    held: dict[int, tuple[list[tuple[int, int]], int]] = {}

    def add(parts, times, gap):
        if times:
            held[len(held)] = (parts, times)
            insort(bins, (gap, len(held) - 1))

    for s in range(capacity, 0, -1):
        k, count[s] = count[s], 0
        while k:
            at = bisect_left(bins, (s, -1))
            if at == len(bins):
                parts, times, gap = [], -(-k // (capacity // s)), capacity
            else:
                gap, i = bins.pop(at)
                parts, times = held[i]
                held[i] = (parts, 0)
            per = gap // s
            full = min(times, k // per)
            add([*parts, (s, per)], full, gap - per * s)
            k -= full * per
            if full < times:
                if k and k < per:
                    add([*parts, (s, k)], 1, gap - k * s)
                    full, k = full + 1, 0
                add(parts, times - full, gap)
    return [(parts, times) for parts, times in held.values() if times]


def intervals(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first number, per sequence, first sequence, offset) sorted by the
    first two: number r of a length stands in sequence first + (r - first number) // per."""
    left = [0] * (capacity + 1)
    for length, n in counts.items():
        left[length] = n
    plan = exact_fills(left, capacity)
    plan += best_fit_rest(left, capacity)
    used, out, sequence = dict.fromkeys(counts, 0), [], 0
    for parts, times in plan:
        offset = 0
        for length, per in parts:
            out.append((length, used[length], per, sequence, offset))
            used[length] += per * times
            offset += per * length
        sequence += times
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def _cut(schema: pa.Schema, tokenizer: str, capacity: int, with_ids: bool):
    def work(batches):
        encoder = Encoder(tokenizer, special=True)

        def rows(batch):
            cols = [[] for _ in schema]
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.each(batch.column(1)), strict=True):
                ids = np.append(ids, np.uint32(0)).astype("<u4")
                first = len(ids) % capacity or capacity
                starts = [0, *range(first, len(ids), capacity)]
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    piece = ids[a:b]
                    for c, v in zip(cols, (doc, k, a, b - a, zlib.crc32(piece.tobytes()), *([piece.tolist()] if with_ids else []))):
                        c.append(v)
                if len(cols[0]) >= 4096:
                    yield tuple(cols)
                    cols = [[] for _ in schema]
            yield tuple(cols)
        return column_batches(batches, schema, rows)
    return work


def _place(schema: pa.Schema, plan: np.ndarray):
    keys = (plan[:, 0] << 44) + plan[:, 1]

    def work(batch):
        length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
        _, first, per, sequence, offset = plan[np.searchsorted(keys, (length << 44) + number, side="right") - 1].T
        q = number - first
        yield tuple(batch.columns[:-1]) + (sequence + q // per, offset + q % per * length)
    return lambda batches: column_batches(batches, schema, work)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset.

    A document is its token ids and a closing 0; over ``capacity`` ids it is cut,
    and the first piece takes the remainder. Every sequence holds at most
    ``capacity`` ids, without gaps. Defined results: null text is empty (one id);
    repeated rows and rows without doc_id are packed as any other; columns but
    doc_id and text are not read; an empty table gives no rows."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    types = "doc_id long, piece int, start long, length long, ids_crc32 long"
    if with_ids:
        fields, types = [*fields, ("ids", pa.list_(pa.int64()))], types + ", ids array<long>"
    cut = texts.mapInArrow(_cut(pa.schema(fields), tokenizer, capacity, with_ids), types)
    pieces = number_within(cut, "length", ["doc_id", "piece"], "number").checkpoint()
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    schema = pa.schema([*fields, ("sequence_id", pa.int64()), ("offset", pa.int64())])
    return pieces.mapInArrow(_place(schema, intervals(counts, capacity)), types + ", sequence_id long, offset long")
