"""MinHash near-dedup with sequential Bayesian verification.

1. Each document becomes the set of its distinct word shingles; documents with
   equal sets form a class, of which the smallest doc_id takes part further on.
2. Min-hash bands of the classes give candidate families: classes connected
   through shared band keys. Every candidate pair lies within one family.
3. Families are cut into blocks of bounded size; a task gets two blocks with
   their full sets. It compares signatures batch by batch, prunes a pair once
   the posterior probability of a link is below ``miss``, and confirms the rest
   on the full sets, most similar first. Pairs already connected need no proof,
   so a task emits a spanning forest: fewer links than documents.
4. Connected components of the confirmed links.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantora.llm.arrays import SHINGLE, column_batches, mix, pieces, shingle_sets
from cantora.llm.graph import components
from cantora.session import ensure_checkpoint_dir

ROWS, BANDS, BATCH = 6, 48, 32   # a pair at 0.80 shares no band with probability 5e-7
HASHES = ROWS * BANDS
BLOCK = 1024
MISS = 1e-7

_draw = np.random.default_rng(20250101)
_MULT = _draw.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_ADD = _draw.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The HASHES min-hashes of a set of 64-bit shingle hashes."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 256):
        np.minimum(out, (x[k:k + 256, None] * _MULT + _ADD).min(axis=0), out=out)
    return out


def least_matches(percent: int, miss: float) -> dict[int, int]:
    """For n = BATCH, 2 BATCH, ... compared hashes, the least number of matches at
    which P(similarity >= percent/100 | matches), under a uniform prior, is above
    ``miss``. That posterior is P(Binomial(n + 1, percent/100) <= matches)."""
    t, out = percent / 100, {}
    for n in range(BATCH, HASHES + 1, BATCH):
        total, k = 0.0, 0
        while True:
            total += math.comb(n + 1, k) * t ** k * (1 - t) ** (n + 1 - k)
            if total > miss:
                break
            k += 1
        out[n] = k
    return out


def _features(schema: pa.Schema, shingle: int):
    def work(batch):
        for p in pieces(batch.column(1)):
            sizes, keys, bands = [], [], []
            for s in shingle_sets(p, shingle):
                sizes.append(len(s))
                if not len(s):
                    keys.append(None)
                    bands.append(None)
                    continue
                # 128 bits of the whole set: sums and xors of two bijections of its members
                a, b = mix(s), mix(s + np.uint64(0x632BE59BD9B4E019))
                keys.append(np.array([a.sum() ^ np.uint64(len(s)), np.bitwise_xor.reduce(b)], np.uint64).tobytes())
                sig = signature(s).reshape(BANDS, ROWS).astype(np.uint64)
                h = np.arange(1, BANDS + 1, dtype=np.uint64)
                for c in range(ROWS):
                    h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, c])
                bands.append(h.view(np.int64))
            yield (batch.column(0).slice(p.first, p.last - p.first), pa.array(sizes, pa.int64()),
                   pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())))
    return lambda batches: column_batches(batches, schema, work)


def _sets(schema: pa.Schema, shingle: int):
    """The last column's texts become their shingle sets; the others pass through."""
    def work(batch):
        *kept, text = batch.columns
        for p in pieces(text):
            sets = [s.tobytes() for s in shingle_sets(p, shingle)]
            yield *(c.slice(p.first, p.last - p.first) for c in kept), pa.array(sets, pa.binary())
    return lambda batches: column_batches(batches, schema, work)


def forest(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None, percent: int, need: dict[int, int]):
    """Links that connect what the candidate pairs connect: all pairs of the
    documents, or those between the two sides. Yields (a, b) ids."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    sig = np.stack([signature(s) for s in sets])
    found = []
    for at in range(0, m, 64):
        i, j = np.meshgrid(np.arange(at, min(at + 64, m)), np.arange(m), indexing="ij")
        low, high = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
        ok = (100 * low >= percent * high) & ((i < j) if side is None else (side[i] < side[j]))
        i, j = i[ok], j[ok]
        same = np.zeros(len(i), np.int64)
        for n in range(BATCH, HASHES + 1, BATCH):
            if not len(i):
                break
            same = same + (sig[i, n - BATCH:n] == sig[j, n - BATCH:n]).sum(axis=1)
            live = same >= need[n]
            i, j, same = i[live], j[live], same[live]
        if len(i):
            found.append((i, j, same))
    if not found:
        return
    i, j, same = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(-same, kind="stable")
    root = list(range(m))

    def top(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(i[order].tolist(), j[order].tolist()):
        ra, rb = top(a), top(b)
        if ra != rb:
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[ra] = rb
                yield int(ids[a]), int(ids[b])


def _verify(percent: int, need: dict[int, int], schema: pa.Schema):
    def work(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        first, second = group.column("x")[0].as_py(), group.column("y")[0].as_py()
        ids = group.column("id").to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
        side = None if first == second else (group.column("block").to_numpy() == second).astype(int)
        links = list(forest(ids, sets, side, percent, need))
        return pa.table([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], schema=schema)
    return work


def near_duplicates(docs: DataFrame, percent: int = 85, shingle: int = SHINGLE, miss: float = MISS,
                    block: int = BLOCK) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept.

    ``docs`` needs doc_id and text; other columns are not read. Documents link
    if 100 * shared shingles >= percent * shingles of either (A-Z lower-cased).
    Defined results: without words (or with null text) a document links with
    nothing; rows that repeat a doc_id are one document with all their links, and
    each of them is returned; a row without doc_id links with nothing, has
    component_id null and is kept; an empty table gives no rows. Texts are used
    whole."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("bands", pa.list_(pa.int64()))])
    feats = texts.mapInArrow(_features(schema, shingle), "id long, n long, key binary, bands array<long>").checkpoint()

    named = feats.where("id is not null and key is not null")
    classes = named.groupBy("key").agg(F.min("id").alias("rep"), F.first("bands").alias("bands")).checkpoint()

    keys = classes.select("rep", F.explode("bands").alias("band"))
    shared = keys.groupBy("band").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).where("lead <> last")
    family = components(keys.join(shared, "band"), "rep", "lead")

    sizes = family.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
    placed = family.join(sizes, "component").select(
        F.col("node").alias("id"), "component", "blocks", F.expr("cast(pmod(xxhash64(node), blocks) as int)").alias("block"))
    schema = pa.schema([("id", pa.int64()), ("component", pa.int64()), ("blocks", pa.int32()), ("block", pa.int32()),
                        ("shingles", pa.binary())])
    bodies = texts.join(placed, "id").select("id", "component", "blocks", "block", "text").mapInArrow(
        _sets(schema, shingle), "id long, component long, blocks int, block int, shingles binary")
    dealt = (bodies.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("id", "block", "shingles", "component", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")))
    links = dealt.groupBy("component", "x", "y").applyInArrow(
        _verify(percent, least_matches(percent, miss), pa.schema([("a", pa.int64()), ("b", pa.int64())])), "a long, b long")
    copies = named.join(classes.select("key", "rep"), "key").where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    linked = components(links.unionByName(copies), "a", "b")
    out = feats.join(linked, F.col("id") == F.col("node"), "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
