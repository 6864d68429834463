"""DuckDB twin of the star-schema bridge, as SQL CTEs.

Every oracle query is ``WITH <STAR>, <its own CTEs> SELECT ...`` over the
driver's pre-registered views. The expressions mirror ``sources.bridge`` and
``operators.forecast.baseline_uplift_fact`` one for one.
"""

from __future__ import annotations

STAR = """
sl AS (
  SELECT l.l_orderkey AS order_key, l.l_linenumber AS line_no,
         CAST(l.l_shipdate AS DATE) AS date_id,
         CAST(regexp_extract(p.p_brand, '[0-9]+', 0) AS INTEGER) AS product_id,
         c.c_nationkey AS region_id,
         CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS channel_id,
         l.l_suppkey AS payer_id,
         CAST(l.l_quantity AS INTEGER) AS units,
         CAST(l.l_extendedprice AS DECIMAL(14,2)) AS gross_sales_chf,
         l.l_discount, l.l_tax, l.l_shipdate
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
fct_sales AS (
  SELECT order_key, line_no, date_id, product_id, region_id, channel_id, units,
         CAST(CASE WHEN units > 0 THEN
              CAST((2 * CAST(gross_sales_chf * 100 AS BIGINT) + units) // (2 * units) AS DECIMAL(14,0))
              * CAST(0.01 AS DECIMAL(3,2)) END AS DECIMAL(12,2)) AS list_price_chf,
         gross_sales_chf
  FROM sl
),
fct_rebates AS (
  SELECT order_key, line_no, date_id, product_id, payer_id, region_id,
         CAST(gross_sales_chf * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(14,2)) AS rebate_chf
  FROM sl
),
fct_promo AS (
  SELECT order_key, line_no, date_id, product_id, region_id, channel_id,
         CAST(gross_sales_chf * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(14,2)) AS spend_chf,
         CAST(GREATEST(1, units // 10) AS INTEGER) AS touchpoints
  FROM sl
),
dim_date AS (
  SELECT CAST(d AS DATE) AS date_id, CAST(year(d) AS INTEGER) AS year,
         CAST(month(d) AS INTEGER) AS month, CAST(week(d) AS INTEGER) AS week,
         CAST(date_trunc('month', d) AS DATE) AS month_start,
         CAST(d AS DATE) - CAST((isodow(d) + 5) % 7 AS INTEGER) AS week_start
  FROM (SELECT CAST(unnest(generate_series(CAST(min(CAST(l_shipdate AS DATE)) AS TIMESTAMP),
                                           CAST(max(CAST(l_shipdate AS DATE)) AS TIMESTAMP),
                                           INTERVAL 1 DAY)) AS DATE) AS d
        FROM lineitem)
),
dim_product AS (
  SELECT CAST(regexp_extract(p_brand, '[0-9]+', 0) AS INTEGER) AS product_id,
         p_brand AS brand, min(p_name) AS molecule, min(p_type) AS atc_code,
         min(p_type) AS indication,
         DATE '1995-01-01' + 30 * CAST(regexp_extract(p_brand, '[0-9]+', 0) AS INTEGER) AS launch_date
  FROM part GROUP BY p_brand
),
dim_region AS (
  SELECT n.n_nationkey AS region_id, n.n_name AS canton, r.r_name AS language_region
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
dim_payer AS (
  SELECT s_suppkey AS payer_id, s_name AS payer_name, 'Insurer' AS payer_type FROM supplier
),
dim_channel AS (
  SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS channel_id,
         o_orderpriority AS channel_name
  FROM (SELECT DISTINCT o_orderpriority FROM orders)
),
fc_s AS (
  SELECT date_id, product_id, region_id, SUM(units) AS units_total, SUM(gross_sales_chf) AS gross
  FROM fct_sales GROUP BY 1, 2, 3
),
fc_r AS (
  SELECT date_id, product_id, region_id, SUM(rebate_chf) AS rebate_chf FROM fct_rebates GROUP BY 1, 2, 3
),
fc_p AS (
  SELECT date_id, product_id, region_id, SUM(spend_chf) AS spend_chf FROM fct_promo GROUP BY 1, 2, 3
),
fc_m AS (
  SELECT s.date_id, s.product_id, s.region_id,
         CAST(s.units_total AS DOUBLE) AS u,
         COALESCE(CAST(p.spend_chf AS DOUBLE), 0.0) AS sp,
         CASE WHEN s.gross > 0 THEN COALESCE(CAST(r.rebate_chf AS DOUBLE), 0.0) / CAST(s.gross AS DOUBLE)
              ELSE 0.0 END AS rr
  FROM fc_s s
  LEFT JOIN fc_r r ON s.date_id = r.date_id AND s.product_id = r.product_id AND s.region_id = r.region_id
  LEFT JOIN fc_p p ON s.date_id = p.date_id AND s.product_id = p.product_id AND s.region_id = p.region_id
),
fc_b AS (
  SELECT *, COALESCE(AVG(u) OVER (PARTITION BY product_id, region_id ORDER BY date_id
                                  ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), 0.0) AS bl
  FROM fc_m
),
fc_u AS (
  SELECT *, LEAST(GREATEST(CAST(0.003 AS DOUBLE) * sp + CAST(-0.5 AS DOUBLE) * (rr * u),
                           CAST(-0.4 AS DOUBLE) * u), CAST(0.5 AS DOUBLE) * u) AS up
  FROM fc_b
),
fct_forecast AS (
  SELECT date_id, product_id, region_id,
         CAST(CAST(floor(bl * 100.0 + 0.5) AS DECIMAL(14,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS baseline_units,
         CAST(CAST(floor(up * 100.0 + 0.5) AS DECIMAL(14,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS uplift_units,
         CAST(CAST(floor(GREATEST(0.0, bl + up) * 100.0 + 0.5) AS DECIMAL(14,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS forecast_units
  FROM fc_u
)
"""


def star_monthly_sql(name: str, fact: str, sums: dict[str, str]) -> str:
    """CTE ``name``: fact joined to date/product/region dims, summed by
    year, month, brand, canton."""
    cols = ",\n         ".join(f"SUM(f.{src}) AS {out}" for out, src in sums.items())
    return f"""{name} AS (
  SELECT d.year, d.month, p.brand, r.canton,
         {cols}
  FROM {fact} f
  JOIN dim_date d ON f.date_id = d.date_id
  JOIN dim_product p ON f.product_id = p.product_id
  JOIN dim_region r ON f.region_id = r.region_id
  GROUP BY 1, 2, 3, 4
)"""


MART_GTN = f"""
{star_monthly_sql("gtn_s", "fct_sales", {"gross_sales_chf": "gross_sales_chf"})},
{star_monthly_sql("gtn_r", "fct_rebates", {"rebates_chf": "rebate_chf"})},
mart_gtn_waterfall AS (
  SELECT s.year, s.month, s.brand, s.canton, s.gross_sales_chf,
         COALESCE(r.rebates_chf, 0) AS rebates_chf,
         s.gross_sales_chf - COALESCE(r.rebates_chf, 0) AS net_sales_chf
  FROM gtn_s s LEFT JOIN gtn_r r
    ON s.year = r.year AND s.month = r.month AND s.brand = r.brand AND s.canton = r.canton
)"""

MART_PERF = f"""
{star_monthly_sql("bp_s", "fct_sales", {"units": "units", "gross_sales_chf": "gross_sales_chf"})},
{star_monthly_sql("bp_p", "fct_promo", {"promo_spend": "spend_chf"})},
mart_brand_perf AS (
  SELECT s.year, s.month, s.brand, s.canton, s.units, s.gross_sales_chf,
         COALESCE(pr.promo_spend, 0) AS promo_spend
  FROM bp_s s LEFT JOIN bp_p pr
    ON s.year = pr.year AND s.month = pr.month AND s.brand = pr.brand AND s.canton = pr.canton
)"""

MART_FC = f"""
{star_monthly_sql("fa_a", "fct_sales", {"actual_units": "units", "actual_gross_chf": "gross_sales_chf"})},
{star_monthly_sql("fa_f", "fct_forecast", {"forecast_units": "forecast_units", "baseline_units": "baseline_units", "uplift_units": "uplift_units"})},
mart_forecast_accuracy AS (
  SELECT a.year, a.month, a.brand, a.canton, a.actual_units, f.forecast_units,
         f.baseline_units, f.uplift_units,
         a.actual_units - f.forecast_units AS abs_error_units,
         CASE WHEN a.actual_units = 0 THEN NULL
              ELSE CAST(abs(a.actual_units - f.forecast_units) AS DOUBLE) / CAST(a.actual_units AS DOUBLE)
         END AS mape_units
  FROM fa_a a LEFT JOIN fa_f f
    ON a.year = f.year AND a.month = f.month AND a.brand = f.brand AND a.canton = f.canton
)"""

SEMANTIC = """
exec_m AS (
  SELECT year, month, brand, canton, SUM(gross_sales_chf) AS gross_sales,
         SUM(rebates_chf) AS rebates, SUM(net_sales_chf) AS net_sales,
         make_date(year, month, 1) AS month_start
  FROM mart_gtn_waterfall GROUP BY year, month, brand, canton
),
perf_m AS (SELECT *, make_date(year, month, 1) AS month_start FROM mart_brand_perf),
fc_mm AS (SELECT *, make_date(year, month, 1) AS month_start FROM mart_forecast_accuracy),
canton_m AS (
  SELECT make_date(p.year, p.month, 1) AS month_start, p.brand, p.canton, p.units,
         p.gross_sales_chf AS gross, g.rebates_chf AS rebates, g.net_sales_chf AS net,
         p.promo_spend AS promo
  FROM mart_brand_perf p LEFT JOIN mart_gtn_waterfall g
    ON p.year = g.year AND p.month = g.month AND p.brand = g.brand AND p.canton = g.canton
),
daily_demand AS (
  SELECT d.date_id, d.date_id AS date_actual, s.product_id, SUM(s.units) AS units
  FROM fct_sales s JOIN dim_date d ON s.date_id = d.date_id
  GROUP BY 1, 2, 3
),
brand_m AS (
  SELECT brand, month_start, SUM(units) AS units, SUM(gross) AS gross, SUM(rebates) AS rebates,
         SUM(net) AS net, SUM(promo) AS promo
  FROM canton_m GROUP BY brand, month_start
)"""

MARTS = f"{MART_GTN},{MART_PERF},{MART_FC},{SEMANTIC}"


def D(col: str, alias: str | None = None) -> str:
    """``CAST(col AS DOUBLE) AS alias``."""
    return f"CAST({col} AS DOUBLE) AS {alias or col.split('.')[-1]}"


def CENTS(expr: str, p: int = 12) -> str:
    """Twin of ``scalar.cents``."""
    return (f"CAST(CAST(floor(CAST({expr} AS DOUBLE) * 100.0 + 0.5) AS DECIMAL({p + 2},0))"
            f" * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL({p},2))")


def R6(expr: str) -> str:
    """Engine-independent half-up rounding to 6 places (twin of ``scalar.r6``)."""
    return f"(floor(CAST({expr} AS DOUBLE) * 1e6 + 0.5) / 1e6)"


def with_star(body: str, marts: bool = True) -> str:
    """``WITH <star>[, <marts>], <body>`` where body is ``cte..., SELECT`` or
    just a final ``SELECT``. Body must start with either ``SELECT`` or a CTE."""
    prefix = STAR.strip() + ("," + MARTS.strip() if marts else "")
    b = body.strip()
    if b.upper().startswith("SELECT"):
        return f"WITH {prefix}\n{b}"
    return f"WITH {prefix},\n{b}"
