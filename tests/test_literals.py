"""Literal frames of FIXTURES.md §D."""
import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cantora.functions.dates import week_start
from cantora.operators import forecast as fc
from cantora.operators import series
from cantora.plans.windows import latest_snapshot


def test_inline_values_snapshot_dedupe(spark):
    """The drill's VALUES relation: the later load of product 101 wins."""
    rows = spark.sql("""SELECT * FROM VALUES
        (101, DATE '2025-05-01', 120, TIMESTAMP_NTZ '2025-05-02 08:00'),
        (101, DATE '2025-05-01', 130, TIMESTAMP_NTZ '2025-05-02 09:00'),
        (102, DATE '2025-05-01',  50, TIMESTAMP_NTZ '2025-05-01 12:00')
        AS t(product_id, as_of_date, units, load_ts)""")
    out = latest_snapshot(rows, ["product_id", "as_of_date"], ["load_ts", "units"]).orderBy("product_id")
    assert [r.units for r in out.collect()] == [130, 50]


def test_metrics(spark):
    df = spark.createDataFrame([(0.0, 10.0), (100.0, 110.0), (200.0, 180.0)], "y double, f double")
    r = df.agg(*fc.metric_columns(F.col("y"), F.col("f"))).collect()[0]
    assert r.mape == pytest.approx(10.0)
    assert r.wape == pytest.approx(13.333333, abs=1e-6)
    assert r.smape == pytest.approx(73.3500, abs=1e-4)
    assert r.rows == 3 and r.null_forecasts == 0


def test_metrics_skip_null_forecasts(spark):
    df = spark.createDataFrame([(100.0, None), (100.0, 110.0)], "y double, f double")
    r = df.agg(*fc.metric_columns(F.col("y"), F.col("f"))).collect()[0]
    assert r.null_forecasts == 1 and r.mape == pytest.approx(10.0)


def _train(spark, rows):
    return spark.createDataFrame(rows, "promo_feat double, rebate_pressure double, uplift_actual double, units double, baseline_units double")


def test_fit_fallback_few_rows(spark):
    t = _train(spark, [(1.0, 2.0, 3.0, 10.0, 5.0)] * 5)
    r = fc.fit(t, "ols").collect()[0]
    assert (r.alpha, r.beta, r.ok) == (0.003, -0.5, False)


def test_fit_fallback_all_zero(spark):
    t = _train(spark, [(0.0, 0.0, 3.0, 10.0, 5.0)] * 8)
    for method in ("ols", "bounded"):
        r = fc.fit(t, method).collect()[0]
        assert (r.alpha, r.beta, r.ok) == (0.003, -0.5, False)
    g = fc.fit_grid(_train(spark, [(0.0, 0.0, 3.0, 10.0, 5.0)] * 5)).collect()[0]
    assert (g.alpha, g.beta, g.ok) == (0.003, -0.5, False)


def test_baseline_window(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([10, 20, 30, 40, 50, 60])], "period int, units double")
    out = series.prev_mean(df.withColumn("g", F.lit(1)), "units", ["g"], "period", 4, "b").orderBy("period")
    assert [r.b for r in out.collect()] == [None, 10.0, 15.0, 20.0, 25.0, 35.0]


def test_week_start_tuesday(spark):
    df = spark.createDataFrame([(dt.date(2025, 8, 11),), (dt.date(2025, 8, 12),)], "d date")
    out = [r.w for r in df.select(week_start(F.col("d")).alias("w")).collect()]
    assert out == [dt.date(2025, 8, 5), dt.date(2025, 8, 12)]


def test_null_propagating_forecast(spark):
    df = spark.createDataFrame([(None, 1.0, 10.0, 8.0), (5.0, 1.0, 10.0, None)],
                               "promo_feat double, rebate_pressure double, units double, baseline_units double")
    out = fc.forecast_with(df, F.lit(0.003), F.lit(-0.5)).collect()
    assert all(r.forecast_units is None for r in out)
