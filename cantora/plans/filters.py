"""Registered filter and predicate queries.

Filters on grouping keys are pushed below the aggregates by Catalyst (and into
the Parquet scan where the column comes straight from a file), so filtering a
mart by brand does not aggregate the other brands.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cantora.operators import forecast as fc
from cantora.operators import semantic
from cantora.operators.star import dim_join
from cantora.plans import marts
from cantora.plans.forecasting import BASE, CAL_SQL, train_sql, window_sql
from cantora.plans.oracle_sql import with_star
from cantora.plans.registry import star_query

# Parameters of the registered examples (a dashboard's widget values).
BRAND = "Brand#13"
CANTON = "NATION_7"
RANGE = ("1996-01-01", "2000-12-01")
WEEKS_PER_BRAND = 78
LAUNCH_LAG_DAYS = 28


def filter_brand_range(df, brand: str, lo: str, hi: str, date_col: str = "month_start"):
    """Brand equality and a closed month range (both ends included)."""
    return df.filter((F.col("brand") == F.lit(brand)) &
                     F.col(date_col).between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))


@star_query("filter_brand_range", with_star(f"""
SELECT year, month, brand, canton, CAST(net_sales AS DOUBLE) AS net_sales, month_start FROM exec_m
WHERE brand = '{BRAND}' AND month_start BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"""))
def q_filter_brand_range(star):
    """Overview rows of one brand within a closed month range."""
    e = semantic.exec_monthly(star).select("year", "month", "brand", "canton", "net_sales", "month_start")
    return filter_brand_range(e, BRAND, *RANGE)


@star_query("filter_param", with_star(f"""
SELECT year, month, canton, CAST(units AS BIGINT) AS units, CAST(gross_sales_chf AS DOUBLE) AS gross_sales_chf,
       CAST(COALESCE(promo_spend, 0) AS DOUBLE) AS promo_spend
FROM mart_brand_perf WHERE brand = '{BRAND}' ORDER BY year, month, canton"""))
def q_filter_param(star):
    """``WHERE brand = :brand`` with a bound parameter, COALESCE projection,
    ORDER BY (Spark SQL named parameters; the text is never spliced)."""
    spark = star.spark
    marts.mart_brand_perf(star).createOrReplaceTempView("mart_brand_perf")
    return spark.sql(
        "SELECT year, month, canton, units, gross_sales_chf, COALESCE(promo_spend, 0) AS promo_spend "
        "FROM mart_brand_perf WHERE brand = :brand ORDER BY year, month, canton", args={"brand": BRAND})


def filter_scope(df, brand: str | None = None, canton: str | None = None):
    """Global (no filter), brand, or brand + canton: an optional conjunction."""
    cond = F.lit(True)
    if brand is not None:
        cond = cond & (F.col("brand") == F.lit(brand))
    if canton is not None:
        cond = cond & (F.col("canton") == F.lit(canton))
    return df.filter(cond)


@star_query("filter_scope", with_star(f"""{CAL_SQL}
SELECT 'global' AS scope, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(SUM(units) AS DOUBLE) AS units FROM cal
UNION ALL SELECT 'brand', CAST(COUNT(*) AS BIGINT), CAST(SUM(units) AS DOUBLE) FROM cal WHERE brand = '{BRAND}'
UNION ALL SELECT 'brand_canton', CAST(COUNT(*) AS BIGINT), CAST(SUM(units) AS DOUBLE) FROM cal
  WHERE brand = '{BRAND}' AND canton = '{CANTON}'"""))
def q_filter_scope(star):
    """The calibration frame under the three scope filters (rows and units
    of each)."""
    frame = fc.calibration_frame(star)
    parts = []
    for name, b, c in (("global", None, None), ("brand", BRAND, None), ("brand_canton", BRAND, CANTON)):
        parts.append(filter_scope(frame, b, c).agg(F.count(F.lit(1)).alias("n_rows"),
                                                   F.sum("units").alias("units"))
                     .select(F.lit(name).alias("scope"), "n_rows", "units"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@star_query("filter_window_launch", with_star(f"""
SELECT s.order_key, s.line_no, s.date_id, s.product_id, s.region_id, s.units
FROM fct_sales s JOIN dim_product p ON s.product_id = p.product_id
WHERE s.date_id >= p.launch_date + {LAUNCH_LAG_DAYS}
  AND s.date_id >= (SELECT CAST(max(date_id) - INTERVAL {WEEKS_PER_BRAND * 7} DAY AS DATE) FROM dim_date)""",
    marts=False))
def q_filter_window_launch(star):
    """Fact rows on or after the product's launch + 4 weeks and inside the
    last 78 weeks of the calendar (cutoff: a one-row aggregate, broadcast)."""
    s = star.fct_sales.select("order_key", "line_no", "date_id", "product_id", "region_id", "units")
    p = star.dim_product.select("product_id", "launch_date")
    cut = star.dim_date.agg(F.date_sub(F.max("date_id"), WEEKS_PER_BRAND * 7).alias("_start"))
    j = dim_join(s, p, "product_id").crossJoin(F.broadcast(cut))
    return j.filter((F.col("date_id") >= F.date_add("launch_date", LAUNCH_LAG_DAYS)) &
                    (F.col("date_id") >= F.col("_start"))) \
        .select("order_key", "line_no", "date_id", "product_id", "region_id", "units")


@star_query("distinct_brands", with_star("""
SELECT brand, CAST(COUNT(DISTINCT canton) AS BIGINT) AS n_cantons FROM mart_brand_perf
WHERE brand IS NOT NULL GROUP BY brand ORDER BY brand"""))
def q_distinct_brands(star):
    """SELECT DISTINCT brand ORDER BY 1, with the cantons each brand sells in
    (NULLs dropped)."""
    m = marts.mart_brand_perf(star).filter(F.col("brand").isNotNull())
    return m.groupBy("brand").agg(F.countDistinct("canton").alias("n_cantons")).orderBy("brand")


@star_query("drop_incomplete", with_star(f"""{BASE},{window_sql('win', [])},{train_sql('train', 'feat', 'win', [])}
SELECT period, brand, canton, units, baseline_units, promo_feat FROM train"""))
def q_drop_incomplete(star):
    """Rows of the default training window with a baseline and a promo feature."""
    frame = fc.calibration_frame(star)
    t = fc.train_rows(fc.add_features(frame), fc.default_window(frame))
    return t.select("period", "brand", "canton", "units", "baseline_units", "promo_feat")


@star_query("split_train_valid", with_star(f"""{CAL_SQL},
w AS (SELECT CAST(max(period) - INTERVAL 24 MONTH AS DATE) AS s, CAST(max(period) - INTERVAL 12 MONTH AS DATE) AS e FROM cal)
SELECT CASE WHEN period >= w.s AND period <= w.e THEN 'train' ELSE 'valid' END AS split,
       CAST(COUNT(*) AS BIGINT) AS n_rows, min(period) AS first_period, max(period) AS last_period
FROM cal CROSS JOIN w WHERE period >= w.s GROUP BY 1"""))
def q_split_train_valid(star):
    """Train = a window (here the 12 months ending a year before the last
    period), valid = after its end, earlier rows in neither."""
    c = fc.calibration_frame(star)
    w = c.agg(F.add_months(F.max("period"), -24).alias("s"), F.add_months(F.max("period"), -12).alias("e"))
    j = c.crossJoin(F.broadcast(w)).filter(F.col("period") >= F.col("s"))
    split = F.when(F.col("period") <= F.col("e"), "train").otherwise("valid")
    return j.groupBy(split.alias("split")).agg(F.count(F.lit(1)).alias("n_rows"),
                                               F.min("period").alias("first_period"),
                                               F.max("period").alias("last_period"))
