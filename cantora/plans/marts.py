"""The three monthly marts (year x month x brand x canton).

Each mart pre-aggregates its two facts separately (the reference does this to
avoid fan-out: a join of two facts before aggregation would multiply rows),
then left-joins the two aggregates on the four keys.

The marts take any object with ``fct_*`` and ``dim_*`` DataFrame attributes:
the bridge star (core facts) or the staging star (cleaned raw records).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantora.operators.star import MONTH_GRAIN, star_monthly



def _zero():
    return F.lit(0).cast("decimal(14,2)")


def mart_gtn_waterfall(star) -> DataFrame:
    """gross, rebates (0 when none) and net = gross - rebates."""
    sales = star_monthly(star.fct_sales, star, {"gross_sales_chf": "gross_sales_chf"})
    rebates = star_monthly(star.fct_rebates, star, {"rebates_chf": "rebate_chf"})
    j = sales.join(rebates, MONTH_GRAIN, "left")
    reb = F.coalesce(F.col("rebates_chf"), _zero())
    return j.select(*MONTH_GRAIN, "gross_sales_chf", reb.alias("rebates_chf"),
                    (F.col("gross_sales_chf") - reb).alias("net_sales_chf"))


def mart_brand_perf(star) -> DataFrame:
    """units, gross, promo spend (0 when none)."""
    sales = star_monthly(star.fct_sales, star,
                         {"units": "units", "gross_sales_chf": "gross_sales_chf"})
    promo = star_monthly(star.fct_promo, star, {"promo_spend": "spend_chf"})
    j = sales.join(promo, MONTH_GRAIN, "left")
    return j.select(*MONTH_GRAIN, "units", "gross_sales_chf",
                    F.coalesce(F.col("promo_spend"), _zero()).alias("promo_spend"))


def mart_forecast_accuracy(star) -> DataFrame:
    """actual vs forecast units. ``abs_error_units`` is *signed* (actual -
    forecast) as in the reference; ``mape_units`` is the per-row fraction
    |actual - forecast| / actual, NULL when actual = 0."""
    actual = star_monthly(star.fct_sales, star,
                          {"actual_units": "units", "actual_gross_chf": "gross_sales_chf"})
    fc = star_monthly(star.fct_forecast, star,
                      {"forecast_units": "forecast_units", "baseline_units": "baseline_units",
                       "uplift_units": "uplift_units"})
    j = actual.join(fc, MONTH_GRAIN, "left")
    err = F.col("actual_units") - F.col("forecast_units")
    ape = F.when(F.col("actual_units") != 0,
                 F.abs(err).cast("double") / F.col("actual_units").cast("double"))
    return j.select(*MONTH_GRAIN, "actual_units", "forecast_units", "baseline_units",
                    "uplift_units", err.alias("abs_error_units"), ape.alias("mape_units"))
