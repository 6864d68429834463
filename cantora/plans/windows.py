"""Registered window queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cantora.functions.scalar import r6
from cantora.operators import semantic, series
from cantora.plans.aggregates import daily_demand
from cantora.plans.joins import SPINE_SQL, spine_brand
from cantora.plans.oracle_sql import R6, with_star
from cantora.plans.registry import star_query


def product_month_sales(star):
    """Monthly gross per product (the period-over-period drill's input)."""
    s = star.fct_sales.groupBy("date_id", "product_id").agg(F.sum("gross_sales_chf").alias("g"))
    j = s.join(star.dim_date.select("date_id", "month_start"), "date_id") \
        .join(star.dim_product.select("product_id", "brand"), "product_id")
    return j.groupBy("month_start", "product_id", "brand").agg(F.sum("g").alias("sales_chf"))


@star_query("win_lag_pop", with_star("""
m AS (SELECT product_id, month_start, sum(gross_sales_chf) AS v FROM fct_sales JOIN dim_date USING (date_id) GROUP BY ALL),
r AS (SELECT x.product_id, x.month_start, max(y.month_start) AS earlier
      FROM m x LEFT JOIN m y ON y.product_id = x.product_id AND y.month_start < x.month_start GROUP BY ALL)
SELECT m.month_start, m.product_id, p.brand, CAST(m.v AS DOUBLE) AS sales_chf, CAST(o.v AS DOUBLE) AS lag_sales,
       CAST(m.v - o.v AS DOUBLE) AS abs_chg, CAST(m.v AS DOUBLE) / CAST(NULLIF(o.v, 0) AS DOUBLE) - 1 AS pct_chg
FROM m JOIN dim_product p ON p.product_id = m.product_id
JOIN r ON r.product_id = m.product_id AND r.month_start = m.month_start
LEFT JOIN m o ON o.product_id = r.product_id AND o.month_start = r.earlier""", marts=False))
def q_win_lag_pop(star):
    """Month sales per product: LAG, absolute and percent change."""
    m = product_month_sales(star)
    out = series.lag_change(m, "sales_chf", ["product_id"], "month_start", prefix="")
    return out.withColumnsRenamed({"lag": "lag_sales"})


MOM_SQL = """
SELECT brand, month_start, CAST(net AS DOUBLE) AS net,
       CAST(LAG(net) OVER (PARTITION BY brand ORDER BY month_start) AS DOUBLE) AS prev_net,
       CAST(net - LAG(net) OVER (PARTITION BY brand ORDER BY month_start) AS DOUBLE) AS abs_chg,
       CASE WHEN LAG(net) OVER (PARTITION BY brand ORDER BY month_start) IS NULL
              OR LAG(net) OVER (PARTITION BY brand ORDER BY month_start) = 0 THEN NULL
            ELSE CAST(net AS DOUBLE) / CAST(LAG(net) OVER (PARTITION BY brand ORDER BY month_start) AS DOUBLE) - 1
       END AS mom_pct
FROM brand_m"""


@star_query("win_lag_mom_brand", with_star(MOM_SQL))
def q_win_lag_mom_brand(star):
    """Month-over-month net growth per brand."""
    bm = semantic.brand_month(star).select("brand", "month_start", "net")
    out = series.lag_change(bm, "net", ["brand"], "month_start")
    return out.withColumnsRenamed({"lag": "prev_net", "pct_chg": "mom_pct"})


@star_query("win_lag_mom_total", with_star("""
t AS (SELECT month_start, SUM(net) AS net FROM brand_m GROUP BY month_start)
SELECT month_start, CAST(net AS DOUBLE) AS net, CAST(LAG(net) OVER (ORDER BY month_start) AS DOUBLE) AS prev_net,
       CAST(net - LAG(net) OVER (ORDER BY month_start) AS DOUBLE) AS abs_chg,
       CASE WHEN LAG(net) OVER (ORDER BY month_start) IS NULL OR LAG(net) OVER (ORDER BY month_start) = 0 THEN NULL
            ELSE CAST(net AS DOUBLE) / CAST(LAG(net) OVER (ORDER BY month_start) AS DOUBLE) - 1 END AS mom_pct
FROM t"""))
def q_win_lag_mom_total(star):
    """Month-over-month growth of the total (one series, on a months-sized
    aggregate, so the un-partitioned window is bounded)."""
    t = semantic.brand_month(star).groupBy("month_start").agg(F.sum("net").alias("net"))
    out = series.lag_change(t, "net", [], "month_start")
    return out.withColumnsRenamed({"lag": "prev_net", "pct_chg": "mom_pct"})


@star_query("win_lag_spine", with_star(f"""{SPINE_SQL}
SELECT brand, month_start, CAST(net AS DOUBLE) AS net,
       CAST(LAG(net) OVER (PARTITION BY brand ORDER BY month_start) AS DOUBLE) AS prev_net,
       CASE WHEN LAG(net) OVER (PARTITION BY brand ORDER BY month_start) IS NULL
              OR LAG(net) OVER (PARTITION BY brand ORDER BY month_start) = 0 THEN NULL
            ELSE CAST(net AS DOUBLE) / CAST(LAG(net) OVER (PARTITION BY brand ORDER BY month_start) AS DOUBLE) - 1
       END AS mom_pct
FROM sp_brand"""))
def q_win_lag_spine(star):
    """LAG over the gap-filled monthly spine (a gap month counts as 0)."""
    sp = spine_brand(star).select("brand", "month_start", "net")
    out = series.lag_change(sp, "net", ["brand"], "month_start")
    return out.drop("abs_chg").withColumnsRenamed({"lag": "prev_net", "pct_chg": "mom_pct"})


@star_query("win_shift_groups", with_star("""
SELECT brand, canton, month_start, CAST(promo_spend AS DOUBLE) AS promo_spend,
       CAST(promo_spend AS DOUBLE) AS promo_lag0,
       CAST(LAG(promo_spend, 1) OVER (PARTITION BY brand, canton ORDER BY month_start) AS DOUBLE) AS promo_lag1
FROM perf_m"""))
def q_win_shift_groups(star):
    """``lag_within_groups`` for lag 0 (identity) and lag 1 per brand x canton."""
    p = semantic.perf_monthly(star).select("brand", "canton", "month_start", "promo_spend")
    w = series.w_series(["brand", "canton"], "month_start")
    return p.withColumns({"promo_lag0": F.col("promo_spend"),
                          "promo_lag1": F.lag("promo_spend", 1).over(w)})


LINE_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def latest_snapshot(df, keys, order_cols):
    """Latest row per key, ordered by ``order_cols`` descending (a total
    order). Expressed as ``max`` of a struct per key: a partial aggregate, so
    a key holding a third of all rows collapses inside each map task instead
    of landing whole in one window partition."""
    payload = [c for c in df.columns if c not in keys and c not in order_cols]
    best = F.max(F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in payload]))
    return df.groupBy(*keys).agg(best.alias("_r")).select(
        *keys, *[F.col(f"_r.{c}").alias(c) for c in order_cols + payload])


@star_query("win_row_number_dedupe", with_star("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate AS load_ts
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                 l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
      FROM lineitem) WHERE rn = 1""", marts=False))
def q_win_row_number_dedupe(spark_star):
    """Latest snapshot per business key (order, line) by load_ts DESC, the rest
    of the row as tie-break; keeps rn = 1 of ROW_NUMBER semantics."""
    li = spark_star.t.lineitem.select(*LINE_COLS).withColumnRenamed("l_shipdate", "load_ts")
    order = ["load_ts", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus"]
    return latest_snapshot(li, ["l_orderkey", "l_linenumber"], order)


@star_query("win_dedupe_dim", with_star("""
SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_totalprice, o_orderpriority
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1""", marts=False))
def q_win_dedupe_dim(spark_star):
    """One row per customer key, newest order first (newest version wins)."""
    o = spark_star.t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus",
                                   "o_totalprice", "o_orderpriority")
    return latest_snapshot(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@star_query("win_rank", with_star("""
SELECT brand, CAST(SUM(net_sales) AS DOUBLE) AS net, CAST(RANK() OVER (ORDER BY SUM(net_sales) DESC) AS INTEGER) AS rnk
FROM exec_m GROUP BY brand"""))
def q_win_rank(star):
    """RANK() OVER (ORDER BY SUM(net) DESC) across brands."""
    b = semantic.exec_monthly(star).groupBy("brand").agg(F.sum("net_sales").alias("net"))
    return b.withColumn("rnk", F.rank().over(Window.orderBy(F.desc_nulls_first("net"))))


@star_query("win_dense_rank", with_star("""
c AS (SELECT brand, canton, SUM(net_sales) AS net FROM exec_m GROUP BY brand, canton)
SELECT brand, canton, CAST(net AS DOUBLE) AS net,
       CAST(DENSE_RANK() OVER (PARTITION BY brand ORDER BY net DESC) AS INTEGER) AS drnk
FROM c"""))
def q_win_dense_rank(star):
    """DENSE_RANK() of cantons by net within each brand."""
    c = semantic.exec_monthly(star).groupBy("brand", "canton").agg(F.sum("net_sales").alias("net"))
    w = Window.partitionBy("brand").orderBy(F.desc_nulls_first("net"))
    return c.withColumn("drnk", F.dense_rank().over(w))


@star_query("win_avg_7d", with_star(f"""
SELECT date_id AS date_actual, product_id, CAST(units AS BIGINT) AS units,
       {R6('AVG(units) OVER (PARTITION BY product_id ORDER BY date_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS avg_7d_units
FROM daily_demand"""))
def q_win_avg_7d(star):
    """Mean of the last 7 daily rows (to current) per product."""
    d = daily_demand(star).withColumnRenamed("date_id", "date_actual")
    w = series.w_series(["product_id"], "date_actual").rowsBetween(-6, 0)
    return d.withColumn("avg_7d_units", r6(F.avg("units").over(w)))


@star_query("win_sum_7", with_star("""
SELECT date_id, product_id, CAST(units AS BIGINT) AS units,
       CAST(SUM(units) OVER (PARTITION BY product_id ORDER BY date_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS sum_7
FROM daily_demand"""))
def q_win_sum_7(star):
    """Moving sum, 6 preceding rows to current, per product."""
    return series.rolling(daily_demand(star), "units", ["product_id"], "date_id", -6, 0,
                          F.sum, "sum_7")


@star_query("win_l12m", with_star("""
SELECT brand, month_start, CAST(net AS DOUBLE) AS net,
       CAST(SUM(net) OVER (PARTITION BY brand ORDER BY month_start ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS DOUBLE) AS l12m_net
FROM brand_m"""))
def q_win_l12m(star):
    """12-row rolling net per brand (on the brand x month aggregate)."""
    bm = semantic.brand_month(star).select("brand", "month_start", "net")
    return series.rolling(bm, "net", ["brand"], "month_start", -11, 0, F.sum, "l12m_net")


@star_query("win_l3m", with_star("""
SELECT brand, month_start, CAST(net AS DOUBLE) AS net,
       CAST(SUM(net) OVER (PARTITION BY brand ORDER BY month_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) AS l3m_net
FROM brand_m"""))
def q_win_l3m(star):
    """3-month rolling net per brand."""
    bm = semantic.brand_month(star).select("brand", "month_start", "net")
    return series.rolling(bm, "net", ["brand"], "month_start", -2, 0, F.sum, "l3m_net")


@star_query("win_running_sum", with_star("""
SELECT date_id, product_id, CAST(units AS BIGINT) AS units,
       CAST(SUM(units) OVER (PARTITION BY product_id ORDER BY date_id) AS BIGINT) AS cum_units
FROM daily_demand"""))
def q_win_running_sum(star):
    """Cumulative units by date per product, default RANGE frame."""
    return series.running_total(daily_demand(star), "units", ["product_id"], "date_id", "cum_units")


@star_query("win_total", with_star("""
v AS (SELECT a.brand, SUM(a.net) AS actual_net, SUM(p.net) AS ly_net
      FROM brand_m a JOIN (SELECT brand, CAST(month_start + INTERVAL 1 YEAR AS DATE) AS month_start, net FROM brand_m) p
      ON a.brand = p.brand AND a.month_start = p.month_start GROUP BY a.brand)
SELECT brand, CAST(actual_net - ly_net AS DOUBLE) AS delta,
       CAST(actual_net - ly_net AS DOUBLE) / CAST(SUM(actual_net - ly_net) OVER () AS DOUBLE) AS share_of_delta
FROM v"""))
def q_win_total(star):
    """Each brand's share of the total delta vs last year, SUM(x) OVER ()."""
    bm = semantic.brand_month(star).select("brand", "month_start", "net")
    v = series.with_last_year(bm, ["brand"], "month_start", "net").groupBy("brand").agg(
        (F.sum("net") - F.sum("ly")).alias("delta"))
    return series.share_of_total(v, "delta", "share_of_delta")


@star_query("win_baseline4", with_star(f"""
SELECT brand, canton, month_start, CAST(units AS BIGINT) AS units,
       {R6('AVG(CAST(units AS DOUBLE)) OVER (PARTITION BY brand, canton ORDER BY month_start ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)')} AS baseline_units
FROM perf_m"""))
def q_win_baseline4(star):
    """Mean of the previous 4 months (at least 1) per brand x canton; NULL
    for a series' first month (the monthly version is not 0-filled)."""
    p = semantic.perf_monthly(star).select("brand", "canton", "month_start", "units")
    out = series.prev_mean(p, "units", ["brand", "canton"], "month_start", 4, "baseline_units")
    return out.withColumn("baseline_units", r6(F.col("baseline_units")))


@star_query("win_cum_share", with_star("""
b AS (SELECT brand, SUM(net) AS net FROM brand_m GROUP BY brand)
SELECT brand, CAST(net AS DOUBLE) AS net,
       CAST(SUM(net) OVER (ORDER BY net DESC) AS DOUBLE) / CAST(SUM(net) OVER () AS DOUBLE) AS cum_share
FROM b"""))
def q_win_cum_share(star):
    """Pareto cumulative share, RANGE frame by net descending (ties share a
    value). Exact decimals until the one division."""
    b = semantic.brand_month(star).groupBy("brand").agg(F.sum("net").alias("net"))
    w = Window.orderBy(F.desc_nulls_first("net")).rangeBetween(Window.unboundedPreceding, 0)
    tot = b.agg(F.sum("net").alias("_tot"))
    return b.withColumn("_cum", F.sum("net").over(w)).crossJoin(F.broadcast(tot)).select(
        "brand", "net", (F.col("_cum").cast("double") / F.col("_tot").cast("double")).alias("cum_share"))


@star_query("win_rolling_band", with_star(f"""
SELECT brand, month_start, CAST(net AS DOUBLE) AS net,
       {R6('AVG(CAST(net AS DOUBLE)) OVER w')} AS roll_mean,
       {R6('STDDEV_SAMP(CAST(net AS DOUBLE)) OVER w')} AS roll_sd,
       {R6('AVG(CAST(net AS DOUBLE)) OVER w - STDDEV_SAMP(CAST(net AS DOUBLE)) OVER w')} AS band_lo,
       {R6('AVG(CAST(net AS DOUBLE)) OVER w + STDDEV_SAMP(CAST(net AS DOUBLE)) OVER w')} AS band_hi
FROM brand_m
WINDOW w AS (PARTITION BY brand ORDER BY month_start ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"""))
def q_win_rolling_band(star):
    """Volatility band: 12-month rolling mean +/- one sample standard deviation."""
    bm = semantic.brand_month(star).select("brand", "month_start", "net")
    w = series.w_series(["brand"], "month_start").rowsBetween(-11, 0)
    x = F.col("net").cast("double")
    mean, sd = F.avg(x).over(w), F.stddev_samp(x).over(w)
    return bm.select("brand", "month_start", "net", r6(mean).alias("roll_mean"),
                     r6(sd).alias("roll_sd"), r6(mean - sd).alias("band_lo"),
                     r6(mean + sd).alias("band_hi"))

