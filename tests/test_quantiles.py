"""Exact quantiles by refinement against numpy and Spark's own percentile."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cantora.operators.quantiles import bin_of, group_quantiles

PROBS = [0.0, 0.05, 0.25, 0.5, 0.77, 1.0]


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, "g string, h int, v double")
    got = {(r.g, r.h): r for r in group_quantiles(df, ["g", "h"], "v", PROBS, **kw).collect()}
    want = df.where("v IS NOT NULL").groupBy("g", "h").agg(F.percentile("v", PROBS).alias("q"), F.count("v").alias("n")).collect()
    assert len(got) == len(want)
    for r in want:
        g = got[r.g, r.h]
        assert g.n == r.n and list(map(repr, g.q)) == list(map(repr, r.q)), (r.g, r.h)


@pytest.mark.parametrize("kw", [{"buckets": 4, "few": 3}, {}])
def test_many_shapes_of_groups(spark, kw):
    rng, rows = random.Random(1), []
    shapes = {
        "even": lambda: rng.random(), "ties": lambda: float(rng.randrange(3)), "same": lambda: 7.5, "far": lambda: math.exp(rng.gauss(0, 60)),
        "tiny": lambda: rng.randrange(9) * 5e-324, "huge": lambda: rng.choice([-1, 1]) * 1.7e308 * rng.random(), "few": lambda: rng.random(), None: lambda: -rng.random()}
    for g, f in shapes.items():
        rows += [(g, h, f()) for h in (1, None) for _ in range(2 if g == "few" else 120)]
    rows += [("even", 1, None)] * 40 + [("none", 1, None)]
    check(spark, rows, **kw)


def test_infinities_and_nan_are_ends_of_the_order(spark):
    rows = [("a", 1, v) for v in [float("inf")] * 9 + [float("-inf")] * 9 + [float("nan")] * 9 + [float(k) for k in range(30)]]
    df = spark.createDataFrame(rows, "g string, h int, v double")
    r = group_quantiles(df, ["g"], "v", [0.0, 8 / 56, 9 / 56, 38 / 56, 39 / 56, 1.0], buckets=4, few=2).first()
    assert r.n == 57 and r.q[0] == r.q[1] == float("-inf") and r.q[2] == 0.0 and r.q[3] == 29.0 and r.q[4] == float("inf") and math.isnan(r.q[5])


def test_one_large_group_without_holding_it(spark):
    v = np.random.default_rng(3).gamma(0.3, size=20_000)
    df = spark.createDataFrame([("x", float(a)) for a in v], "g string, v double")
    r = group_quantiles(df, ["g"], "v", [0.1, 0.5, 0.999], buckets=16, few=8).first()
    assert np.allclose(r.q, np.quantile(v, [0.1, 0.5, 0.999]), rtol=1e-12) and (r.lo, r.hi) == (v.min(), v.max())


def test_empty_and_bins(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert group_quantiles(df, ["g"], "v", [0.5]).collect() == []
    b = spark.createDataFrame([(float(k),) for k in range(11)], "v double").select(bin_of(F.col("v"), F.lit(0.0), F.lit(10.0), 5).alias("b"))
    assert [r.b for r in b.collect()] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 4]
    assert spark.range(1).select(bin_of(F.lit(2.0), F.lit(2.0), F.lit(2.0), 5).alias("b")).first().b == 0
