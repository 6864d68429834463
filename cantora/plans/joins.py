"""Registered join queries. All joins are equi-joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cantora.functions.dates import make_month
from cantora.operators import semantic, series
from cantora.operators.star import DAY_GRAIN, MONTH_GRAIN, dim_join
from cantora.plans import marts
from cantora.plans.oracle_sql import with_star
from cantora.plans.registry import star_query


@star_query("join_inner_star", with_star("""
SELECT s.order_key, s.line_no, s.date_id, d.year, d.month, p.brand, r.canton, s.units,
       CAST(s.gross_sales_chf AS DOUBLE) AS gross_sales_chf
FROM fct_sales s
JOIN dim_date d ON s.date_id = d.date_id
JOIN dim_product p ON s.product_id = p.product_id
JOIN dim_region r ON s.region_id = r.region_id"""))
def q_join_inner_star(star):
    """Fact rows inner-joined to date, product and region (orphans drop out)."""
    s = star.fct_sales.select("order_key", "line_no", "date_id", "product_id", "region_id",
                              "units", "gross_sales_chf")
    j = dim_join(s, star.dim_date.select("date_id", "year", "month"), "date_id")
    j = dim_join(j, star.dim_product.select("product_id", "brand"), "product_id")
    j = dim_join(j, star.dim_region.select("region_id", "canton"), "region_id")
    return j.select("order_key", "line_no", "date_id", "year", "month", "brand", "canton",
                    "units", "gross_sales_chf")


def left_star(star):
    s = star.fct_sales
    j = dim_join(s, star.dim_date.select("date_id", "year", "month"), "date_id", "left")
    j = dim_join(j, star.dim_product.select("product_id", "brand", "molecule"), "product_id", "left")
    j = dim_join(j, star.dim_region.select("region_id", "canton"), "region_id", "left")
    j = dim_join(j, star.dim_channel.select("channel_id", "channel_name"), "channel_id", "left")
    return j.select(make_month(F.col("year"), F.col("month")).alias("month_start"),
                    "order_key", "line_no", "date_id", "product_id", "region_id", "channel_id",
                    "brand", "molecule", "canton", "channel_name", "units", "gross_sales_chf")


LEFT_STAR_SQL = """
left_star AS (
  SELECT make_date(d.year, d.month, 1) AS month_start, s.order_key, s.line_no,
         s.date_id, s.product_id, s.region_id, s.channel_id,
         p.brand, p.molecule, r.canton, c.channel_name, s.units, s.gross_sales_chf
  FROM fct_sales s
  LEFT JOIN dim_date d ON s.date_id = d.date_id
  LEFT JOIN dim_product p ON s.product_id = p.product_id
  LEFT JOIN dim_region r ON s.region_id = r.region_id
  LEFT JOIN dim_channel c ON s.channel_id = c.channel_id
)"""


@star_query("join_left_star", with_star(f"""{LEFT_STAR_SQL}
SELECT month_start, order_key, line_no, date_id, product_id, region_id, channel_id, brand,
       molecule, canton, channel_name, units, CAST(gross_sales_chf AS DOUBLE) AS gross_sales_chf
FROM left_star"""))
def q_join_left_star(star):
    """Fact rows left-joined to four dimensions (orphans kept with NULLs)."""
    return left_star(star)


@star_query("join_left_star_agg", with_star(f"""{LEFT_STAR_SQL}
SELECT month_start, brand, canton, channel_name, CAST(COUNT(*) AS BIGINT) AS n_rows,
       CAST(SUM(units) AS BIGINT) AS units, CAST(SUM(gross_sales_chf) AS DOUBLE) AS gross_sales_chf
FROM left_star GROUP BY month_start, brand, canton, channel_name"""))
def q_join_left_star_agg(star):
    """Left star aggregated to month x brand x canton x channel (grain check).
    The fact is first summed per (date, product, region, channel), so the
    dimension joins see day-grain rows only."""
    daily = star.fct_sales.groupBy(*DAY_GRAIN, "channel_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("units").alias("units"),
        F.sum("gross_sales_chf").alias("gross_sales_chf"))
    j = (daily.join(star.dim_date.select("date_id", "year", "month"), "date_id", "left")
         .join(star.dim_product.select("product_id", "brand"), "product_id", "left")
         .join(star.dim_region.select("region_id", "canton"), "region_id", "left")
         .join(star.dim_channel.select("channel_id", "channel_name"), "channel_id", "left"))
    j = j.withColumn("month_start", make_month(F.col("year"), F.col("month")))
    return j.groupBy("month_start", "brand", "canton", "channel_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("units").alias("units"),
        F.sum("gross_sales_chf").alias("gross_sales_chf"))


@star_query("join_left_composite", with_star("""
SELECT p.year, p.month, p.brand, p.canton, CAST(p.units AS BIGINT) AS units,
       CAST(COALESCE(p.promo_spend, 0) AS DOUBLE) AS promo_spend,
       CAST(g.gross_sales_chf AS DOUBLE) AS gross_sales_chf, CAST(g.rebates_chf AS DOUBLE) AS rebates_chf
FROM mart_brand_perf p LEFT JOIN
  (SELECT year, month, brand, canton, SUM(gross_sales_chf) AS gross_sales_chf, SUM(rebates_chf) AS rebates_chf
   FROM mart_gtn_waterfall GROUP BY 1, 2, 3, 4) g
  ON g.year = p.year AND g.month = p.month AND g.brand = p.brand AND g.canton = p.canton"""))
def q_join_left_composite(star):
    """Aggregate LEFT JOIN aggregate on year, month, brand, canton."""
    p = marts.mart_brand_perf(star).select(*MONTH_GRAIN, "units", "promo_spend")
    g = marts.mart_gtn_waterfall(star).groupBy(*MONTH_GRAIN).agg(
        F.sum("gross_sales_chf").alias("gross_sales_chf"), F.sum("rebates_chf").alias("rebates_chf"))
    return p.join(g, MONTH_GRAIN, "left")


@star_query("join_left_fill", with_star("""
jf_s AS (SELECT date_id, product_id, region_id, SUM(units) AS units_total, SUM(gross_sales_chf) AS gross
         FROM fct_sales GROUP BY 1, 2, 3),
jf_r AS (SELECT date_id, product_id, region_id, SUM(rebate_chf) AS rebate_chf FROM fct_rebates GROUP BY 1, 2, 3)
SELECT s.date_id, s.product_id, s.region_id, CAST(s.units_total AS BIGINT) AS units_total,
       CAST(s.gross AS DOUBLE) AS gross_sales_chf, CAST(COALESCE(r.rebate_chf, 0) AS DOUBLE) AS rebate_chf,
       CASE WHEN s.gross > 0 THEN CAST(COALESCE(r.rebate_chf, 0) AS DOUBLE) / CAST(s.gross AS DOUBLE)
            ELSE 0.0 END AS rebate_rate
FROM jf_s s LEFT JOIN jf_r r
  ON s.date_id = r.date_id AND s.product_id = r.product_id AND s.region_id = r.region_id""", marts=False))
def q_join_left_fill(star):
    """Daily sales LEFT JOIN daily rebates on three keys, missing rebates = 0,
    rebate rate (0 when gross <= 0)."""
    s = star.fct_sales.groupBy(*DAY_GRAIN).agg(F.sum("units").alias("units_total"),
                                               F.sum("gross_sales_chf").alias("gross_sales_chf"))
    r = star.fct_rebates.groupBy(*DAY_GRAIN).agg(F.sum("rebate_chf").alias("rebate_chf"))
    j = s.join(r, DAY_GRAIN, "left").na.fill({"rebate_chf": 0})
    rate = F.when(F.col("gross_sales_chf") > 0,
                  F.col("rebate_chf").cast("double") / F.col("gross_sales_chf").cast("double")
                  ).otherwise(0.0)
    return j.withColumn("rebate_rate", rate)


SPINE_SQL = """
sp_bounds AS (SELECT min(month_start) AS lo, max(month_start) AS hi FROM brand_m),
sp_months AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month_start FROM sp_bounds),
sp_brand AS (
  SELECT b.brand, m.month_start, COALESCE(x.net, 0) AS net, COALESCE(x.units, 0) AS units
  FROM (SELECT DISTINCT brand FROM brand_m) b CROSS JOIN sp_months m
  LEFT JOIN brand_m x ON x.brand = b.brand AND x.month_start = m.month_start
)"""


def spine_brand(star):
    bm = semantic.brand_month(star)
    return series.densify(bm, "brand", "month_start", ["net", "units"])


@star_query("join_using_spine", with_star(f"""{SPINE_SQL}
SELECT brand, month_start, CAST(net AS DOUBLE) AS net, CAST(units AS BIGINT) AS units FROM sp_brand"""))
def q_join_using_spine(star):
    """Month spine LEFT JOIN monthly net per brand, gaps filled with 0."""
    return spine_brand(star)


@star_query("join_spine_total", with_star("""
st_b AS (SELECT min(date_id) AS lo, max(date_id) AS hi FROM fct_sales),
st_m AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP),
                 CAST(date_trunc('month', hi) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month_start FROM st_b)
SELECT m.month_start, CAST(COALESCE(SUM(s.gross_sales_chf), 0) AS DOUBLE) AS gross_sales_chf,
       CAST(COUNT(s.date_id) AS BIGINT) AS n_rows
FROM st_m m LEFT JOIN fct_sales s ON CAST(date_trunc('month', s.date_id) AS DATE) = m.month_start
GROUP BY m.month_start""", marts=False))
def q_join_spine_total(star):
    """Month spine LEFT JOIN the fact on its truncated date, then SUM. The
    fact is summed per month first (map-side), so the join is months-sized."""
    s = star.fct_sales
    m = s.groupBy(F.trunc("date_id", "month").alias("month_start")).agg(
        F.sum("gross_sales_chf").alias("g"), F.count("date_id").alias("n"))
    bounds = s.agg(F.min("date_id").alias("lo"), F.max("date_id").alias("hi"))
    spine = series.month_spine(bounds)
    j = spine.join(m, "month_start", "left")
    return j.select("month_start",
                    F.coalesce("g", F.lit(0).cast("decimal(24,2)")).alias("gross_sales_chf"),
                    F.coalesce("n", F.lit(0).cast("bigint")).alias("n_rows"))


@star_query("join_yoy_self", with_star("""
SELECT a.brand, a.month_start, CAST(a.net AS DOUBLE) AS net, CAST(b.net AS DOUBLE) AS ly_net,
       CASE WHEN b.net IS NULL OR b.net = 0 THEN NULL
            ELSE CAST(a.net AS DOUBLE) / CAST(b.net AS DOUBLE) - 1 END AS yoy_pct
FROM brand_m a LEFT JOIN brand_m b
  ON b.brand = a.brand AND b.month_start = CAST(a.month_start - INTERVAL 1 YEAR AS DATE)"""))
def q_join_yoy_self(star):
    """Self LEFT JOIN on month_start - 1 year, YoY growth (NULL if LY is 0)."""
    bm = semantic.brand_month(star).select("brand", "month_start", "net")
    ly = bm.select("brand", F.add_months("month_start", 12).alias("month_start"), F.col("net").alias("ly_net"))
    j = bm.join(ly, ["brand", "month_start"], "left")
    pct = F.when(F.col("ly_net").isNull() | (F.col("ly_net") == 0), F.lit(None).cast("double")) \
        .otherwise(F.col("net").cast("double") / F.col("ly_net").cast("double") - 1.0)
    return j.withColumn("yoy_pct", pct)


@star_query("join_cross_total", with_star("""
ct AS (SELECT canton, SUM(net_sales) AS net FROM exec_m GROUP BY canton)
SELECT c.canton, CAST(c.net AS DOUBLE) AS net, CAST(t.total AS DOUBLE) AS total_net,
       CAST(c.net AS DOUBLE) / CAST(t.total AS DOUBLE) AS share
FROM ct c CROSS JOIN (SELECT SUM(net) AS total FROM ct) t"""))
def q_join_cross_total(star):
    """Canton net next to the grand total (a proven one-row frame, broadcast)."""
    e = semantic.exec_monthly(star)
    c = e.groupBy("canton").agg(F.sum("net_sales").alias("net"))
    t = c.agg(F.sum("net").alias("total_net"))
    return c.crossJoin(F.broadcast(t)).withColumn(
        "share", F.col("net").cast("double") / F.col("total_net").cast("double"))


@star_query("join_variance_inner", with_star("""
SELECT a.brand, a.month_start, CAST(a.net AS DOUBLE) AS actual_net, CAST(p.net AS DOUBLE) AS plan_net,
       CAST(a.net - p.net AS DOUBLE) AS variance
FROM brand_m a JOIN (SELECT brand, CAST(month_start + INTERVAL 1 YEAR AS DATE) AS month_start, net FROM brand_m) p
  USING (month_start, brand)"""))
def q_join_variance_inner(star):
    """Actual INNER JOIN plan USING (month_start, brand); the plan is the same
    brand and month one year earlier."""
    bm = semantic.brand_month(star).select("brand", "month_start", "net")
    plan = bm.select("brand", F.add_months("month_start", 12).alias("month_start"),
                     F.col("net").alias("plan_net"))
    j = bm.join(plan, ["month_start", "brand"], "inner")
    return j.select("brand", "month_start", F.col("net").alias("actual_net"), "plan_net",
                    (F.col("net") - F.col("plan_net")).alias("variance"))


@star_query("join_semi_fk", with_star("""
SELECT s.product_id, CAST(COUNT(*) AS BIGINT) AS covered_rows
FROM fct_sales s WHERE EXISTS (SELECT 1 FROM dim_product p WHERE p.product_id = s.product_id)
GROUP BY s.product_id"""))
def q_join_semi_fk(star):
    """Fact rows covered by the product dimension (LEFT SEMI), per product."""
    s = star.fct_sales.select("product_id")
    return dim_join(s, star.dim_product.select("product_id"), "product_id", "left_semi") \
        .groupBy("product_id").agg(F.count(F.lit(1)).alias("covered_rows"))
