"""Semantic monthly views over the marts (the layer the dashboards read).

* ``exec_monthly``  gross, rebates, net by year, month, brand, canton (+ month_start)
* ``perf_monthly``  units, gross, promo by the same grain (+ month_start)
* ``fc_monthly``    forecast-accuracy mart (+ month_start)
* ``brand_month``   brand x month_start: units, gross, rebates, net, promo
* ``canton_month``  brand x canton x month_start with the same measures

All are aggregates of aggregates: their size is bounded by months x brands x
cantons, independent of fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantora.functions.dates import make_month
from cantora.operators.star import MONTH_GRAIN
from cantora.plans import marts


def exec_monthly(star) -> DataFrame:
    m = marts.mart_gtn_waterfall(star)
    g = m.groupBy(*MONTH_GRAIN).agg(
        F.sum("gross_sales_chf").alias("gross_sales"),
        F.sum("rebates_chf").alias("rebates"),
        F.sum("net_sales_chf").alias("net_sales"))
    return g.withColumn("month_start", make_month(F.col("year"), F.col("month")))


def perf_monthly(star) -> DataFrame:
    m = marts.mart_brand_perf(star)
    return m.withColumn("month_start", make_month(F.col("year"), F.col("month")))


def fc_monthly(star) -> DataFrame:
    m = marts.mart_forecast_accuracy(star)
    return m.withColumn("month_start", make_month(F.col("year"), F.col("month")))


def canton_month(star) -> DataFrame:
    """Both marts side by side at month x brand x canton (perf LEFT JOIN gtn).

    Built from one sales aggregate with rebates and promo left-joined, which
    is the same relation as joining the two marts (their rows are both the
    sales keys; missing rebates / promo are 0) but scans and aggregates the
    sales fact once instead of twice."""
    from cantora.operators.star import star_monthly
    sales = star_monthly(star.fct_sales, star, {"units": "units", "gross": "gross_sales_chf"})
    reb = star_monthly(star.fct_rebates, star, {"rebates": "rebate_chf"})
    promo = star_monthly(star.fct_promo, star, {"promo": "spend_chf"})
    zero = F.lit(0).cast("decimal(14,2)")
    j = sales.join(reb, MONTH_GRAIN, "left").join(promo, MONTH_GRAIN, "left")
    r = F.coalesce(F.col("rebates"), zero)
    return j.select(
        make_month(F.col("year"), F.col("month")).alias("month_start"), "brand", "canton",
        "units", "gross", r.alias("rebates"), (F.col("gross") - r).alias("net"),
        F.coalesce(F.col("promo"), zero).alias("promo"))


def brand_month(star) -> DataFrame:
    c = canton_month(star)
    return c.groupBy("brand", "month_start").agg(
        F.sum("units").alias("units"), F.sum("gross").alias("gross"),
        F.sum("rebates").alias("rebates"), F.sum("net").alias("net"),
        F.sum("promo").alias("promo"))
