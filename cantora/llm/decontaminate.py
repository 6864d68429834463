"""Benchmark decontamination by greedy string tiling.

The benchmark is read in slices of bounded bytes; a slice's tokens and the
hashes of its token n-grams (the seeds) go to every task. A task hashes its
documents' n-grams with a running hash over the whole batch, joins them to the
slice's seeds through a bit table and a sorted array, and for every (document,
item) that shares enough seeds tiles the two: the longest common stretch of
unmarked tokens is marked again and again, until none of ``least`` tokens is
left. A document whose tiles cover the threshold of an item is contaminated,
in whatever order it has the item's parts. Documents are never shuffled, so a
passage in very many of them makes no hot key, and a larger benchmark means
more slices, not larger ones."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantora.llm.arrays import Piece, column_batches, gram_hashes, pieces, word_hashes, words

LEAST = 5           # tokens of the shortest match that counts
COVERAGE = 50       # percent of an item's tokens
SLICE_BYTES = 8 << 20
_BITS = 22


class Index(NamedTuple):
    """Seeds of a slice of the benchmark: sorted hashes with the item and place of each, and items' lengths."""
    seeds: np.ndarray
    item: np.ndarray
    place: np.ndarray
    length: np.ndarray
    table: np.ndarray   # bit table over the low bits of the seeds


def build_index(texts: list[str], least: int) -> Index:
    column = pa.array(texts, pa.large_string())
    seeds, items, places, lengths = [], [], [], []
    for p in pieces(column):
        w, grams, rows, at = _grams(p, least)
        seeds.append(grams)
        items.append(rows + p.first)
        places.append(at - w.first[rows])
        lengths.append(np.diff(w.first))
    seeds, items, places = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((seeds, np.uint64), (items, np.int64), (places, np.int64)))
    order = np.lexsort((places, items, seeds))
    table = np.zeros(1 << _BITS, bool)
    table[(seeds & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True
    return Index(seeds[order], items[order], places[order], np.concatenate(lengths) if lengths else np.zeros(0, np.int64), table)


def _grams(p: Piece, least: int):
    """Words, hashes of the n-grams within a row, their rows and their first word."""
    w = words(p)
    grams = gram_hashes(word_hashes(p, w, lower=True), least)
    at = np.flatnonzero(w.row[:len(grams)] == w.row[least - 1:]) if len(grams) else np.zeros(0, np.int64)
    return w, grams[at], w.row[at], at


def tiles(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from the pairs of places whose n-grams are equal:
    (place in the document, place in the item, tokens), longest first, ties by
    place. No token is in two tiles."""
    order = np.lexsort((doc, doc - item))
    i, j = doc[order], item[order]
    cut = np.flatnonzero((np.diff(i - j) != 0) | (np.diff(i) != 1)) + 1
    begin, end = np.concatenate(([0], cut)), np.concatenate((cut, [len(i)]))
    heap = [(-(e - b + least - 1), int(j[b]), int(i[b])) for b, e in zip(begin.tolist(), end.tolist())]
    heapq.heapify(heap)
    in_doc, in_item, out = set(), set(), []
    while heap:
        n, y, x = heapq.heappop(heap)
        n = -n
        free = [k for k in range(n) if x + k not in in_doc and y + k not in in_item]
        if len(free) == n:
            out.append((x, y, n))
            in_doc.update(range(x, x + n))
            in_item.update(range(y, y + n))
            continue
        run = 0
        for a, k in enumerate(free):   # what is left of it, in stretches
            run += 1
            if a + 1 == len(free) or free[a + 1] != k + 1:
                if run >= least:
                    heapq.heappush(heap, (-run, y + k - run + 1, x + k - run + 1))
                run = 0
    return out


def matches(p: Piece, index: Index, least: int, percent: int) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """(row, item, tiles) of the contaminated rows of a piece."""
    if not len(index.seeds):
        return
    w, grams, rows, at = _grams(p, least)
    hit = np.flatnonzero(index.table[(grams & np.uint64((1 << _BITS) - 1)).astype(np.int64)])
    low = np.searchsorted(index.seeds, grams[hit], side="left")
    many = np.searchsorted(index.seeds, grams[hit], side="right") - low
    hit, low, many = hit[many > 0], low[many > 0], many[many > 0]
    if not len(hit):
        return
    post = np.repeat(low - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
    hit = np.repeat(hit, many)
    row, item, x, y = rows[hit], index.item[post], at[hit] - w.first[rows[hit]], index.place[post]
    order = np.lexsort((item, row))
    row, item, x, y = row[order], item[order], x[order], y[order]
    cut = np.flatnonzero((np.diff(row) != 0) | (np.diff(item) != 0)) + 1
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(row)]):
        length = int(index.length[item[a]])
        covered = np.zeros(length + least, np.int64)   # an upper bound: all tokens under some seed
        np.add.at(covered, y[a:b], 1)
        np.add.at(covered, y[a:b] + least, -1)
        if 100 * int((np.cumsum(covered)[:length] > 0).sum()) < percent * length:
            continue
        found = tiles(x[a:b], y[a:b], least)
        if 100 * sum(n for _, _, n in found) >= percent * length:
            yield int(row[a]), int(item[a]), found


def _slices(benchmark: DataFrame, least: int, slice_bytes: int) -> Iterator[tuple[list[str], Index]]:
    """The benchmark's distinct texts in slices of about ``slice_bytes``."""
    texts = benchmark.select(F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // slice_bytes))
    for k in range(n):
        part = sorted(r["text"] for r in texts.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).collect())
        yield part, build_index(part, least)


def leaks(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, percent: int = COVERAGE, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row a contaminated (document, item): doc_id, item_id, item_words,
    covered_words, and ``tiles``, an array of (doc_word, item_word, words).

    Words are runs of non-space characters with A-Z lower-cased. Defined
    results: null and empty texts match nothing, nor do items of fewer than
    ``least`` words; items of equal text all match; rows that repeat are judged
    one by one and each gives its rows; a row without doc_id gives rows with a
    null; other columns are not read; an empty table gives no rows."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tile = pa.struct([("doc_word", pa.int64()), ("item_word", pa.int64()), ("words", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("item_text", pa.string()), ("item_words", pa.int64()), ("covered_words", pa.int64()), ("tiles", pa.list_(tile))])
    out = None
    for part, index in _slices(benchmark, least, slice_bytes):
        sent = spark.sparkContext.broadcast((part, index))

        def work(batch, sent=sent):
            part, index = sent.value
            for p in pieces(batch.column(1)):
                found = list(matches(p, index, least, percent))
                yield (batch.column(0).take(pa.array([p.first + r for r, _, _ in found], pa.int64())), [part[i] for _, i, _ in found],
                       [int(index.length[i]) for _, i, _ in found], [sum(n for _, _, n in t) for _, _, t in found],
                       [[dict(zip(("doc_word", "item_word", "words"), x)) for x in t] for _, _, t in found])

        one = rows.mapInArrow(lambda batches, work=work: column_batches(batches, schema, work),
                              "doc_id long, item_text string, item_words long, covered_words long, tiles array<struct<doc_word:long,item_word:long,words:long>>")
        out = one if out is None else out.unionByName(one)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("item_text"))
    return out.join(items, "item_text").select("doc_id", "item_id", "item_words", "covered_words", "tiles")


def clean(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, percent: int = COVERAGE, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with their columns as they are."""
    at = docs.columns.index("text")
    for _, index in _slices(benchmark, least, slice_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def work(batches, sent=sent):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for p in pieces(batch.column(at)):
                    for row, _, _ in matches(p, sent.value, least, percent):
                        keep[p.first + row] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(work, docs.schema)
    return docs
