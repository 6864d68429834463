"""Exact quantiles per group by histogram and refinement, and equal-width bins.

A quantile of n values needs the values of at most two ranks. A histogram with
a fixed number of buckets between a group's least and largest value (summed
map-side, with each bucket's own least and largest value) tells which bucket
holds a rank; that bucket becomes the next range, for all ranks of all groups in
the same pass. A range whose least and largest value are equal, or that has few
enough values to sort, is settled. So no task ever holds a group's values, the
result is exact, and each pass narrows a range by the number of buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantora.session import scratch_path

BUCKETS = 1024
SORTED = 1024      # values of a range that are sorted in one row


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _place(v: Column, lo: Column, hi: Column, buckets: int) -> Column:
    """Bucket of a value between lo < hi: never decreasing in v, first for lo, last for hi."""
    wide = F.abs(hi - lo) == F.lit(float("inf"))
    share = F.when(wide, (v / 2 - lo / 2) / (hi / 2 - lo / 2)).otherwise((v - lo) / (hi - lo))
    return F.least(F.lit(buckets - 1), F.floor(share * buckets)).cast("int")


def _keys(keys: list[str], side: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(f"{side}{k}"))
    return out


def _as(df: DataFrame, keys: list[str], side: str) -> DataFrame:
    return df.withColumnsRenamed({k: f"{side}{k}" for k in keys})


def group_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float], buckets: int = BUCKETS, few: int = SORTED) -> DataFrame:
    """keys, n, lo, hi, q: for every group with a value, their number, the least and largest,
    and the quantiles at ``probs`` (linear between neighbouring ranks, as ``percentile``).

    NULL values are left out, NULL keys are a group. Infinite values are ordinary ones;
    NaN is above all of them, as in Spark's order."""
    v = _written(df.select(*keys, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL"), "quantile-values")
    stats = _written(v.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")), "quantile-groups")
    places = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(x), F.ceil(x)) for x in places])))
    # rank r of the group is the k-th value (from 0) of the range lo..hi, which has c values
    open_ = stats.select(*keys, F.explode(ranks).alias("r"), "n", "lo", "hi").select(*keys, "r", F.col("r").alias("k"), F.col("n").alias("c"), "lo", "hi")
    settled: list[DataFrame] = []
    while True:
        open_ = _written(open_, "quantile-ranges")
        settled.append(open_.where("lo = hi").select(*keys, "r", F.col("lo").alias("x")))
        open_ = open_.where("lo < hi")
        if open_.isEmpty():
            break
        ranges = open_.groupBy(*keys).agg(F.collect_set(F.struct("lo", "hi", (F.col("c") <= few).alias("few"))).alias("_ranges"))  # two a quantile at most
        right = _as(ranges, keys, "_r_")
        inside = v.join(right, _keys(keys, "_r_")).select(*keys, "_v", F.explode(F.expr("filter(_ranges, x -> _v >= x.lo AND _v <= x.hi)")).alias("_x"))
        inside = inside.select(*keys, "_v", "_x.lo", "_x.hi", "_x.few")
        by = [*keys, "lo", "hi"]
        lists = inside.where("few").groupBy(*by).agg(F.sort_array(F.collect_list("_v")).alias("_list"))
        short = open_.where(F.col("c") <= few)
        settled.append(short.join(_as(lists, by, "_l_"), _keys(by, "_l_")).select(*keys, "r", F.col("_list")[F.col("k").cast("int")].alias("x")))
        long = open_.where(F.col("c") > few)
        if long.isEmpty():
            break
        # infinities, and NaN above them, have buckets of their own at the ends
        finite_lo, finite_hi = F.greatest("lo", F.lit(-1.7976931348623157e308)), F.least("hi", F.lit(1.7976931348623157e308))
        bucket = F.when(F.isnan("_v"), buckets + 1).when(F.col("_v") < finite_lo, -1).when(F.col("_v") > finite_hi, buckets).when(finite_lo >= finite_hi, 0).otherwise(_place(F.col("_v"), finite_lo, finite_hi, buckets))
        hist = inside.where("NOT few").groupBy(*by, bucket.alias("b")).agg(F.count(F.lit(1)).alias("c"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
        w = Window.partitionBy(*by).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)      # at most ``buckets`` + 3 rows
        hist = hist.withColumn("before", F.coalesce(F.sum("c").over(w), F.lit(0)))
        h = _as(hist, by, "_h_").withColumnsRenamed({"c": "_c"})
        hit = long.join(h, _keys(by, "_h_") & (F.col("k") >= F.col("before")) & (F.col("k") < F.col("before") + F.col("_c")))
        open_ = hit.select(*keys, "r", (F.col("k") - F.col("before")).alias("k"), F.col("_c").alias("c"), F.col("_min").alias("lo"), F.col("_max").alias("hi"))
    values = settled[0]
    for s in settled[1:]:
        values = values.unionByName(s)
    found = values.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col("r").cast("long").alias("r"), "x"))).alias("_at"))
    j = stats.join(_as(found, keys, "_f_"), _keys(keys, "_f_"))

    def at(place: Column) -> Column:
        low, high = F.col("_at")[F.floor(place).cast("long")], F.col("_at")[F.ceil(place).cast("long")]
        return F.when((F.floor(place) == F.ceil(place)) | (low == high), low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high)

    return j.select(*keys, "n", "lo", "hi", F.array(*[at(x) for x in places]).alias("q"))


def bin_of(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin 0..bins-1 of a value between a group's least and largest one."""
    return F.when(lo < hi, F.least(F.lit(bins - 1), F.floor((v - lo) / (hi - lo) * bins).cast("int"))).otherwise(F.lit(0))
