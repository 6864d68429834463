"""Vectorised text primitives on Arrow batches (run inside Spark tasks).

A batch's text column is one UTF-8 byte buffer plus row offsets, so words,
word hashes and shingle hashes of many documents come from a few array passes
without one Python object a word. Batches are cut into pieces of bounded bytes
at row boundaries (a longer document is a piece of its own, never cut)."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = bytes([0x20, *range(0x09, 0x0E)])
PIECE_BYTES = 1 << 18
SLICE_ROWS = 512   # rows of a batch converted at once
SHINGLE = 5

_BASE = 0x9E3779B97F4A7C55 | 1
_U = np.uint64
_is_space = np.zeros(256, bool)
_is_space[list(SPACES)] = True
_plain = np.arange(1, 257, dtype=_U)
_lower = _plain.copy()
_lower[65:91] += _U(32)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i up to n (kept, grown on demand)."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, 2 * PIECE_BYTES)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, _U)
            p[0] = 1
            _powers[name] = np.cumprod(p)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Piece(NamedTuple):
    """Rows first..last of a batch: their bytes and where each row begins."""
    first: int
    last: int
    data: np.ndarray     # uint8
    offsets: np.ndarray  # int64, last - first + 1 values from 0


def pieces(column: pa.Array, most: int = PIECE_BYTES) -> Iterator[Piece]:
    """The column's texts (null: empty) in pieces of at most ``most`` bytes or one row."""
    for k in range(0, len(column), SLICE_ROWS):
        for p in _pieces(column.slice(k, SLICE_ROWS), most):
            yield p._replace(first=k + p.first, last=k + p.last)


def _pieces(column: pa.Array, most: int) -> Iterator[Piece]:
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    bufs = column.buffers()
    offs = np.frombuffer(bufs[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, side="right")) - 1)
        yield Piece(i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        i = j


class Words(NamedTuple):
    start: np.ndarray   # byte offset in the piece
    end: np.ndarray
    row: np.ndarray     # row within the piece
    first: np.ndarray   # index of each row's first word; one more value at the end


def words(p: Piece) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every row."""
    n = len(p.data)
    if not n:
        z = np.zeros(0, np.int64)
        return Words(z, z, z, np.zeros(len(p.offsets), np.int64))
    space = _is_space[p.data]
    inside = ~space
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= space[:-1]
    stop[:-1] &= space[1:]
    full = p.offsets[:-1] < p.offsets[1:]
    at, till = p.offsets[:-1][full], p.offsets[1:][full] - 1
    begin[at], stop[till] = inside[at], inside[till]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    row = np.searchsorted(p.offsets[1:], start, side="right")
    first = np.searchsorted(row, np.arange(len(p.offsets)))
    return Words(start, end, row, first)


def prefix_hash(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Prefix sums H of a polynomial rolling hash: see ``span_hash``."""
    up, _ = _power(len(data))
    h = np.zeros(len(data) + 1, _U)
    np.cumsum((_lower if lower else _plain)[data] * up[:len(data)], out=h[1:])
    return h


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the byte spans, equal for equal bytes wherever they stand."""
    _, down = _power(len(h))
    return mix((h[end] - h[start]) * down[start])


def word_hashes(p: Piece, w: Words, lower: bool = False) -> np.ndarray:
    return span_hash(prefix_hash(p.data, lower), w.start, w.end)


def gram_hashes(tokens: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive tokens (len(tokens) - n + 1 values, not cut at rows)."""
    m = len(tokens) - n + 1
    if m <= 0:
        return np.zeros(0, _U)
    h = np.zeros(m, _U)
    for k in range(n):
        h *= _U(_BASE)
        h += tokens[k:k + m]
    return mix(h ^ _U(n))


def shingle_sets(p: Piece, n: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its n-word shingles, A-Z lower-cased;
    of fewer words the whole sequence is the one shingle, without words there is none."""
    w = words(p)
    tokens = word_hashes(p, w, lower=True)
    grams = gram_hashes(tokens, n)
    for r in range(len(p.offsets) - 1):
        a, b = w.first[r], w.first[r + 1]
        if b - a >= n:
            yield np.unique(grams[a:b - n + 1])
        elif b > a:
            yield gram_hashes(tokens[a:b], int(b - a))
        else:
            yield np.zeros(0, _U)


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive uint64 values, by block-wise prefix and suffix minima."""
    n = len(v) - w + 1
    full = np.full(-(-len(v) // w) * w, np.iinfo(np.uint64).max, _U)
    full[:len(v)] = v
    blocks = full.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


def column_batches(batches: Iterator[pa.RecordBatch], schema: pa.Schema, work) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: ``work(batch)`` yields tuples of columns in schema order."""
    for batch in batches:
        for cols in work(batch):
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)]
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)
