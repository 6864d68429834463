"""Registered aggregation queries: marts and monthly rollups."""

from __future__ import annotations

from pyspark.sql import functions as F

from cantora.operators.star import dim_join
from cantora.plans import marts
from cantora.plans.oracle_sql import with_star
from cantora.plans.registry import star_query

D = "CAST({0} AS DOUBLE) AS {0}".format


@star_query("mart_gtn_waterfall", with_star(f"""
SELECT year, month, brand, canton, {D('gross_sales_chf')}, {D('rebates_chf')}, {D('net_sales_chf')}
FROM mart_gtn_waterfall"""))
def q_mart_gtn_waterfall(star):
    """Gross-to-net waterfall mart."""
    return marts.mart_gtn_waterfall(star)


@star_query("mart_brand_perf", with_star(f"""
SELECT year, month, brand, canton, CAST(units AS BIGINT) AS units, {D('gross_sales_chf')}, {D('promo_spend')}
FROM mart_brand_perf"""))
def q_mart_brand_perf(star):
    """Brand performance mart."""
    return marts.mart_brand_perf(star)


@star_query("mart_forecast_accuracy", with_star(f"""
SELECT year, month, brand, canton, CAST(actual_units AS BIGINT) AS actual_units,
       {D('forecast_units')}, {D('baseline_units')}, {D('uplift_units')}, {D('abs_error_units')},
       mape_units
FROM mart_forecast_accuracy"""))
def q_mart_forecast_accuracy(star):
    """Forecast accuracy mart (signed error, fractional APE)."""
    return marts.mart_forecast_accuracy(star)


# ---------------------------------------------------------------------------
# dashboard rollups over the marts (all brands at once; a page picks one)
# ---------------------------------------------------------------------------
from pyspark.sql import Window  # noqa: E402

from cantora.functions.dates import make_month, period_label  # noqa: E402
from cantora.functions.scalar import r6  # noqa: E402
from cantora.operators import semantic  # noqa: E402
from cantora.operators.star import DAY_GRAIN  # noqa: E402
from cantora.plans.oracle_sql import R6  # noqa: E402
from cantora.plans.oracle_sql import D as DD  # noqa: E402


@star_query("agg_exec_monthly", with_star(f"""
SELECT year, month, brand, canton, {DD('gross_sales')}, {DD('rebates')}, {DD('net_sales')}, month_start
FROM exec_m"""))
def q_agg_exec_monthly(star):
    """SUM gross/rebates/net by year, month, brand, canton plus month start."""
    return semantic.exec_monthly(star)


@star_query("agg_brand_trend", with_star(f"""
SELECT brand, year, month, year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period,
       CAST(SUM(gross_sales) AS DOUBLE) AS gross_sales, CAST(SUM(net_sales) AS DOUBLE) AS net_sales
FROM exec_m GROUP BY brand, year, month"""))
def q_agg_brand_trend(star):
    """Gross and net per month of each brand (the page shows one brand)."""
    e = semantic.exec_monthly(star)
    g = e.groupBy("brand", "year", "month").agg(F.sum("gross_sales").alias("gross_sales"),
                                                F.sum("net_sales").alias("net_sales"))
    return g.withColumn("period", period_label(F.col("year"), F.col("month")))


@star_query("agg_perf_trend", with_star(f"""
SELECT brand, year, month, year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period,
       CAST(SUM(units) AS BIGINT) AS units, CAST(SUM(gross_sales_chf) AS DOUBLE) AS gross_sales_chf,
       CAST(SUM(promo_spend) AS DOUBLE) AS promo_spend
FROM mart_brand_perf GROUP BY brand, year, month"""))
def q_agg_perf_trend(star):
    """Units, gross, promo per month of each brand."""
    m = marts.mart_brand_perf(star)
    g = m.groupBy("brand", "year", "month").agg(
        F.sum("units").alias("units"), F.sum("gross_sales_chf").alias("gross_sales_chf"),
        F.sum("promo_spend").alias("promo_spend"))
    return g.withColumn("period", period_label(F.col("year"), F.col("month")))


def fc_topline(star):
    f = semantic.fc_monthly(star)
    return f.groupBy("brand", "month_start").agg(
        F.sum("actual_units").alias("actual_units"),
        F.sum("forecast_units").alias("forecast_units"),
        F.sum("baseline_units").alias("baseline_units"),
        F.sum("uplift_units").alias("uplift_units"),
        r6(F.avg("mape_units")).alias("mape_units"))


FC_TOPLINE_SQL = f"""
fc_top AS (
  SELECT brand, month_start, CAST(SUM(actual_units) AS BIGINT) AS actual_units,
         SUM(forecast_units) AS forecast_units, SUM(baseline_units) AS baseline_units,
         SUM(uplift_units) AS uplift_units, {R6('AVG(mape_units)')} AS mape_units
  FROM fc_mm GROUP BY brand, month_start
)"""


@star_query("agg_fc_topline", with_star(f"""{FC_TOPLINE_SQL}
SELECT brand, month_start, actual_units, {DD('forecast_units')}, {DD('baseline_units')},
       {DD('uplift_units')}, mape_units FROM fc_top"""))
def q_agg_fc_topline(star):
    """Month topline over cantons: sums and the unweighted mean of mape_units."""
    return fc_topline(star)


@star_query("agg_canton_net", with_star("""
SELECT brand, canton, CAST(SUM(net_sales) AS DOUBLE) AS net_sales
FROM exec_m GROUP BY brand, canton ORDER BY brand, net_sales DESC"""))
def q_agg_canton_net(star):
    """Net by canton (per brand), descending."""
    e = semantic.exec_monthly(star)
    return e.groupBy("brand", "canton").agg(F.sum("net_sales").alias("net_sales")) \
        .orderBy("brand", F.desc_nulls_last("net_sales"))


def latest_per_brand(df, date_col="month_start"):
    """Rows of each brand's latest month. ``max`` over a window partitioned
    by brand on a month-grain frame (bounded by months x cantons per brand)."""
    w = Window.partitionBy("brand")
    return df.withColumn("_latest", F.max(date_col).over(w)) \
        .filter(F.col(date_col) == F.col("_latest")).drop("_latest")


@star_query("agg_canton_latest", with_star("""
SELECT brand, canton, CAST(SUM(units) AS BIGINT) AS units,
       CAST(SUM(gross_sales_chf) AS DOUBLE) AS gross_sales_chf,
       CAST(SUM(promo_spend) AS DOUBLE) AS promo_spend
FROM perf_m p
WHERE month_start = (SELECT max(month_start) FROM perf_m q WHERE q.brand = p.brand)
GROUP BY brand, canton"""))
def q_agg_canton_latest(star):
    """Units, gross, promo by canton in each brand's latest month."""
    p = latest_per_brand(semantic.perf_monthly(star))
    return p.groupBy("brand", "canton").agg(
        F.sum("units").alias("units"), F.sum("gross_sales_chf").alias("gross_sales_chf"),
        F.sum("promo_spend").alias("promo_spend"))


@star_query("agg_fc_canton_latest", with_star(f"""
SELECT brand, canton, CAST(SUM(actual_units) AS BIGINT) AS actual_units,
       CAST(SUM(forecast_units) AS DOUBLE) AS forecast_units,
       CAST(SUM(baseline_units) AS DOUBLE) AS baseline_units,
       CAST(SUM(uplift_units) AS DOUBLE) AS uplift_units, {R6('AVG(mape_units)')} AS mape_units
FROM fc_mm f
WHERE month_start = (SELECT max(month_start) FROM fc_mm g WHERE g.brand = f.brand)
GROUP BY brand, canton"""))
def q_agg_fc_canton_latest(star):
    """Forecast vs actual by canton in each brand's latest month."""
    f = latest_per_brand(semantic.fc_monthly(star))
    return f.groupBy("brand", "canton").agg(
        F.sum("actual_units").alias("actual_units"),
        F.sum("forecast_units").alias("forecast_units"),
        F.sum("baseline_units").alias("baseline_units"),
        F.sum("uplift_units").alias("uplift_units"),
        r6(F.avg("mape_units")).alias("mape_units"))


def daily_demand(star):
    s = star.fct_sales.groupBy("date_id", "product_id").agg(F.sum("units").alias("units"))
    return s.join(star.dim_date.select("date_id"), "date_id")




@star_query("agg_daily_demand", with_star("""
SELECT date_id, product_id, CAST(units AS BIGINT) AS units FROM daily_demand"""))
def q_agg_daily_demand(star):
    """Units per day x product (fact pre-summed, then joined to the calendar)."""
    return daily_demand(star)


def forecast_inputs(star):
    keys = DAY_GRAIN
    s = star.fct_sales.groupBy(*keys).agg(F.sum("units").alias("units"),
                                          F.sum("gross_sales_chf").alias("gross_sales_chf"))
    r = star.fct_rebates.groupBy(*keys).agg(F.sum("rebate_chf").alias("rebate_chf"))
    p = star.fct_promo.groupBy(*keys).agg(F.sum("spend_chf").alias("spend_chf"),
                                          F.sum("touchpoints").alias("touchpoints"))
    j = s.join(r, keys, "left").join(p, keys, "left")
    zero = F.lit(0).cast("decimal(14,2)")
    return j.select(*keys, "units", "gross_sales_chf",
                    F.coalesce("rebate_chf", zero).alias("rebate_chf"),
                    F.coalesce("spend_chf", zero).alias("spend_chf"),
                    F.coalesce("touchpoints", F.lit(0).cast("bigint")).alias("touchpoints"))


@star_query("agg_forecast_inputs", with_star("""
fi_s AS (SELECT date_id, product_id, region_id, SUM(units) AS units, SUM(gross_sales_chf) AS gross_sales_chf
         FROM fct_sales GROUP BY 1, 2, 3),
fi_r AS (SELECT date_id, product_id, region_id, SUM(rebate_chf) AS rebate_chf FROM fct_rebates GROUP BY 1, 2, 3),
fi_p AS (SELECT date_id, product_id, region_id, SUM(spend_chf) AS spend_chf, SUM(touchpoints) AS touchpoints
         FROM fct_promo GROUP BY 1, 2, 3)
SELECT s.date_id, s.product_id, s.region_id, CAST(s.units AS BIGINT) AS units,
       CAST(s.gross_sales_chf AS DOUBLE) AS gross_sales_chf,
       CAST(COALESCE(r.rebate_chf, 0) AS DOUBLE) AS rebate_chf,
       CAST(COALESCE(p.spend_chf, 0) AS DOUBLE) AS spend_chf,
       CAST(COALESCE(p.touchpoints, 0) AS BIGINT) AS touchpoints
FROM fi_s s
LEFT JOIN fi_r r ON s.date_id = r.date_id AND s.product_id = r.product_id AND s.region_id = r.region_id
LEFT JOIN fi_p p ON s.date_id = p.date_id AND s.product_id = p.product_id AND s.region_id = p.region_id"""))
def q_agg_forecast_inputs(star):
    """Per date x product x region: units, gross, rebates, promo spend, touchpoints."""
    return forecast_inputs(star)


@star_query("agg_count_distinct", with_star("""
SELECT p.brand, d.month_start, CAST(COUNT(DISTINCT s.order_key) AS BIGINT) AS orders,
       CAST(COUNT(DISTINCT s.region_id) AS BIGINT) AS regions
FROM fct_sales s JOIN dim_product p ON s.product_id = p.product_id
JOIN dim_date d ON s.date_id = d.date_id
GROUP BY p.brand, d.month_start"""))
def q_agg_count_distinct(star):
    """COUNT(DISTINCT order) and COUNT(DISTINCT region) per brand x month."""
    s = star.fct_sales.select("order_key", "region_id", "product_id", "date_id")
    j = dim_join(s, star.dim_product.select("product_id", "brand"), "product_id")
    j = dim_join(j, star.dim_date.select("date_id", "month_start"), "date_id")
    return j.groupBy("brand", "month_start").agg(
        F.countDistinct("order_key").alias("orders"), F.countDistinct("region_id").alias("regions"))


@star_query("agg_having_dupes", with_star("""
SELECT order_key, line_no, CAST(COUNT(*) AS BIGINT) AS n
FROM fct_sales GROUP BY order_key, line_no HAVING COUNT(*) > 1"""))
def q_agg_having_dupes(star):
    """Business keys (order, line) that occur more than once."""
    return star.fct_sales.groupBy("order_key", "line_no").agg(F.count(F.lit(1)).alias("n")) \
        .filter(F.col("n") > 1)


@star_query("agg_month_rows", with_star("""
SELECT CAST(date_trunc('month', date_id) AS DATE) AS month_start, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM fct_sales GROUP BY 1"""))
def q_agg_month_rows(star):
    """Fact rows per month (coverage)."""
    return star.fct_sales.groupBy(F.trunc("date_id", "month").alias("month_start")) \
        .agg(F.count(F.lit(1)).alias("n_rows"))


@star_query("agg_min_max_date", with_star("""
SELECT min(date_id) AS min_date, max(date_id) AS max_date, CAST(COUNT(*) AS BIGINT) AS n_rows FROM fct_sales"""))
def q_agg_min_max_date(star):
    """Date range of the sales fact."""
    return star.fct_sales.agg(F.min("date_id").alias("min_date"), F.max("date_id").alias("max_date"),
                              F.count(F.lit(1)).alias("n_rows"))


@star_query("agg_last_per_group", with_star("""
SELECT brand, year, month, canton, CAST(gross_sales AS DOUBLE) AS gross_sales,
       CAST(rebates AS DOUBLE) AS rebates, CAST(net_sales AS DOUBLE) AS net_sales
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY brand ORDER BY year DESC, month DESC, canton DESC) AS rn
      FROM exec_m) WHERE rn = 1"""))
def q_agg_last_per_group(star):
    """Last row per brand after sorting by (year, month, canton): ``max_by`` on
    a struct, a partial aggregate (no window, no sort of the group)."""
    e = semantic.exec_monthly(star)
    row = F.struct("year", "month", "canton", "gross_sales", "rebates", "net_sales")
    g = e.groupBy("brand").agg(F.max_by(row, F.struct("year", "month", "canton")).alias("r"))
    return g.select("brand", "r.*")


@star_query("agg_of_agg_share", with_star(f"""
SELECT brand, CAST(SUM(net_sales) AS DOUBLE) AS net_sales,
       CAST(SUM(net_sales) AS DOUBLE) / CAST(SUM(SUM(net_sales)) OVER () AS DOUBLE) AS share
FROM exec_m GROUP BY brand"""))
def q_agg_of_agg_share(star):
    """SUM(net) / SUM(SUM(net)) OVER (): the grand total is a one-row
    aggregate (size proven) broadcast to every brand row."""
    e = semantic.exec_monthly(star)
    b = e.groupBy("brand").agg(F.sum("net_sales").alias("net_sales"))
    tot = b.agg(F.sum("net_sales").alias("_tot"))
    return b.crossJoin(F.broadcast(tot)).select(
        "brand", "net_sales",
        (F.col("net_sales").cast("double") / F.col("_tot").cast("double")).alias("share"))


@star_query("agg_promo_by_product", with_star("""
SELECT product_id, date_id, region_id, CAST(SUM(units) AS BIGINT) AS units,
       round_even(CAST(SUM(units) AS DOUBLE) * 1.0, 2) AS spend_chf,
       CAST(GREATEST(1, CAST(trunc(CAST(SUM(units) AS DOUBLE) * 0.02) AS BIGINT)) AS BIGINT) AS touchpoints
FROM fct_sales GROUP BY product_id, date_id, region_id"""))
def q_agg_promo_by_product(star):
    """Per product: units by date x region, derived spend (units x factor,
    rounded half-even to cents) and touchpoints (units x rate, truncated, at
    least 1). Factor 1.0 and rate 0.02 are the midpoints of the reference's
    unseeded draws."""
    g = star.fct_sales.groupBy("product_id", "date_id", "region_id").agg(F.sum("units").alias("units"))
    u = F.col("units").cast("double")
    return g.select("product_id", "date_id", "region_id", "units",
                    F.bround(u * F.lit(1.0), 2).alias("spend_chf"),
                    F.greatest(F.lit(1).cast("bigint"), (u * F.lit(0.02)).cast("bigint")).alias("touchpoints"))
