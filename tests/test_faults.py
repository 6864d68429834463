"""Fault injection: exact k, repeatable, replayable by the oracle."""
import hashlib
import math

from pyspark.sql import functions as F

from cantora.operators import faults
from cantora.sources import raw as R


def test_mask_exact_k_and_repeatable(spark, star_small):
    b = R.sales_base(star_small)
    n = b.count()
    st = [faults.Stage("a", 0.15), faults.Stage("b", 0.02), faults.Stage("d", 0.0), faults.Stage("e", 0.0, True)]
    m1 = faults.with_masks(b, "raw_key", st)
    counts = m1.agg(*[F.count_if(f"_m{i}").alias(f"c{i}") for i in range(4)]).collect()[0]
    assert counts.c0 == math.floor(0.15 * n)
    assert counts.c1 == math.floor(0.02 * n)
    assert counts.c2 == 0 and counts.c3 == 1
    keys1 = {r.raw_key for r in m1.filter("_m0").select("raw_key").collect()}
    keys2 = {r.raw_key for r in faults.with_masks(b, "raw_key", st).filter("_m0").select("raw_key").collect()}
    assert keys1 == keys2


def test_chain_row_counts_and_cleanup(spark, star_small):
    raw = R.raw_frame(star_small, "sales")
    n = star_small.fct_sales.count()
    assert raw.count() == n + max(1, math.floor(0.02 * n))
    assert all(t == "string" for c, t in raw.dtypes if c not in ("raw_ingest_ts",))
    stg = R.stg_sales(raw)
    # quirk: units formatted with two decimals come back x100 from clean_int
    messed = raw.filter(F.col("units").rlike(r"^\d+\.\d{2}$")).count()
    assert messed > 0
    assert stg.filter(F.col("units") >= 100).count() >= messed


def _sorted_cuts(keys, stages):
    hashes = {s.name: sorted(hashlib.md5(f"{faults.SEED}|{s.name}|{k}".encode()).hexdigest() for k in keys) for s in stages}
    n = len(keys)
    rank = {s.name: min(n, max(1, math.floor(s.rate * n))) if s.at_least_one else math.floor(s.rate * n) for s in stages}
    return {k: h[rank[k] - 1] if rank[k] else None for k, h in hashes.items()}


CUT_STAGES = [faults.Stage("a", 0.15), faults.Stage("b", 0.02), faults.Stage("c", 0.0), faults.Stage("d", 0.5), faults.Stage("e", 1.0), faults.Stage("f", 0.0, True)]


def test_cuts_take_one_pass_over_the_base(spark):
    rows = spark.sparkContext.accumulator(0)

    def seen(k):
        rows.add(1)
        return f"k{k}"

    base = spark.range(0, 20_000, numPartitions=4).select(F.udf(seen, "string")("id").alias("k"))
    cuts = faults.stage_cuts(base, "k", CUT_STAGES)
    assert rows.value <= 20_000        # the base is counted without its columns
    assert cuts == _sorted_cuts([f"k{k}" for k in range(20_000)], CUT_STAGES)


def test_cuts_of_rows_that_come_many_times(spark):
    # three keys of many copies each: the k-th smallest hash is nowhere near k / n
    keys = [f"k{k % 3}" for k in range(3_000)] + ["one"]
    assert faults.stage_cuts(spark.createDataFrame([(k,) for k in keys], "k string"), "k", CUT_STAGES) == _sorted_cuts(keys, CUT_STAGES)
    assert faults.stage_cuts(spark.createDataFrame([], "k string"), "k", CUT_STAGES) == dict.fromkeys("abcdef")
