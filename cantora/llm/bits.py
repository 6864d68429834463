"""A bit table of fixed size over 64-bit hashes: a filter before a shuffle.

It lets some values through that are not in the set and never stops one that
is, so results don't depend on it; its size does not grow with the data."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 25


def bit_table(df: DataFrame, hashed: str, bits: int = BITS) -> np.ndarray:
    """The table of the long column ``hashed``, as 2**bits / 64 words; the words are
    put together in Spark, and at most that many reach the driver."""
    at = F.col(hashed).bitwiseAND(F.lit((1 << bits) - 1))
    words = df.groupBy(F.shiftright(at, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({hashed} & 63 as int))")).alias("b")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return out.view(np.uint64)


def maybe_in(table: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Which of the uint64 hashes may be in the table."""
    at = hashed & np.uint64(len(table) * 64 - 1)
    return (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
