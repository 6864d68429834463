"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows of equal text form a group and stay together. Best-fit decreasing needs
only how many groups there are of each size: a run of equal groups fills the
tightest bin that holds one, as often as it does, then the next tightest. The
packing is thus planned exactly over the histogram of group sizes, and every
group finds its bin from its number within its size. Distinct sizes that sum to
the corpus are at most the square root of twice its bytes; the histogram, which
is far smaller in practice, is what the driver holds."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantora.llm.ranks import number_within

SHARDS = 8
HOT = 1000  # rows of groups over 1/HOT of a shard are not moved to find their shard


def best_fit(runs: list[tuple[int, int]], bins: int, capacity: int) -> list[tuple[int, int, int]] | None:
    """(size, first, bin) of the groups from number ``first`` of a size on; ``runs`` are
    (size, count) in descending order. Every group enters the bin of least remaining
    capacity that holds it; None if one finds no bin.

    The gaps stand in a sorted list, one entry a bin: after a group the tightest bin
    is still the tightest one while it holds another of that size."""
    gaps = [(capacity, b) for b in range(bins)]
    out = []
    for size, n in runs:
        first = 0
        while first < n:
            k = bisect_left(gaps, (size, -1))
            if k == len(gaps):
                return None
            gap, b = gaps.pop(k)
            out.append((size, first, b))
            times = min(n - first, gap // size)
            first += times
            insort(gaps, (gap - times * size, b))
    return out


def plan(counts: dict[int, int], bins: int) -> list[tuple[int, int, int]]:
    """``best_fit`` at the least capacity at which it holds all. A group over an even
    share of what is left has a bin to itself, and the others share the rest."""
    left, alone, taken = sum(s * n for s, n in counts.items()), [], Counter()
    for size in sorted(counts, reverse=True):
        while taken[size] < counts[size] and len(alone) < bins - 1 and size * (bins - len(alone)) > left:
            alone.append((size, taken[size], len(alone)))
            taken[size] += 1
            left -= size
        if taken[size] < counts[size]:
            break
    runs = [(s, n - taken[s]) for s, n in sorted(counts.items(), reverse=True) if n > taken[s]]
    if not runs:
        return alone
    k = bins - len(alone)
    low = high = max(runs[0][0], -(-left // k))
    while best_fit(runs, k, high) is None:
        low, high = high + 1, high + max(1, (high * 3) // 1000)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if best_fit(runs, k, mid) is not None else (mid + 1, high)
    return alone + [(s, taken[s] + first, len(alone) + b) for s, first, b in best_fit(runs, k, high)]


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law (``bytes``), shard, slot, grown_shard (null).

    Shards get near equal bytes and hold whole groups of equal texts; a group
    larger than an even share has a shard to itself. Defined results: null text
    counts as empty (size 1) and shares its group; repeated rows and rows
    without doc_id are placed as any other; columns but doc_id and text are not
    read; an empty table gives no rows."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("group"))
    groups = rows.groupBy("group").agg(F.sum("size").alias("of"))
    groups = number_within(groups, "of", ["group"], "number").checkpoint()
    counts = {r["of"]: r["count"] for r in groups.groupBy("of").count().collect()}  # one row a distinct size
    intervals = spark.createDataFrame(plan(counts, shards), "planned long, first long, shard int")
    # the last interval of a size that begins at or before a group's number; a size has one a
    # shard at most. Spark broadcasts the plan if it is small and splits skewed sizes if not
    steps = intervals.groupBy("planned").agg(F.sort_array(F.collect_list(F.struct("first", "shard"))).alias("steps"))
    where = groups.join(steps, F.col("of") == F.col("planned")).select(
        F.col("group").alias("own"), "of", F.element_at(F.filter("steps", lambda x: x["first"] <= F.col("number")), -1)["shard"].alias("shard")).checkpoint()
    total = sum(s * n for s, n in counts.items())
    hot = F.col("of") * (shards * HOT) > total  # at most shards * HOT groups
    by_hot = F.broadcast(where.where(hot).select(F.col("own").alias("hot_own"), F.col("shard").alias("hot_shard")))
    rows = rows.join(by_hot, F.col("group") == F.col("hot_own"), "left")
    kept = ["doc_id", "size", "text_crc32"]
    placed = rows.where("hot_shard is not null").select(*kept, F.col("hot_shard").alias("shard"))
    placed = placed.unionByName(rows.where("hot_shard is null").join(where.where(~hot), F.col("group") == F.col("own")).select(*kept, "shard"))
    placed = placed.withColumn("law", F.lit("bytes"))
    out = number_within(placed, "shard", ["doc_id", "size", "text_crc32"], "slot")
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
