"""Registered source / sink / catalog queries.

Writes go to a fresh folder under the shared checkpoint directory
(``session.scratch_path``) and are read back, so each query exercises the
sink and the source.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cantora.operators import keys, semantic, series
from cantora.operators.profile import profiles
from cantora.plans import marts
from cantora.plans.cleaning import stg_sql
from cantora.plans.oracle_sql import with_star
from cantora.plans.registry import star_query
from cantora.session import scratch_path
from cantora.sources import raw as R
from cantora.sources.store import derive, month_of

# The reference's channel seed list.
SEED_CHANNELS = ["Retail", "Hospital", "Specialty"]


@star_query("src_scan", with_star("""
SELECT product_id, CAST(SUM(units) AS BIGINT) AS units, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM fct_sales WHERE units >= 1 GROUP BY product_id""", marts=False))
def q_src_scan(star):
    """SQL with a named parameter over a registered view of the sales fact."""
    star.fct_sales.createOrReplaceTempView("fct_sales")
    return star.spark.sql(
        "SELECT product_id, SUM(units) AS units, COUNT(*) AS n_rows FROM fct_sales "
        "WHERE units >= :min_units GROUP BY product_id", args={"min_units": 1})


PROMO_SCHEMA = T.StructType([
    T.StructField("date_id", T.DateType()), T.StructField("product_id", T.IntegerType()),
    T.StructField("region_id", T.IntegerType()), T.StructField("channel_id", T.IntegerType()),
    T.StructField("spend_chf", T.DecimalType(14, 2)), T.StructField("touchpoints", T.IntegerType())])


@star_query("src_csv_roundtrip", with_star("""
SELECT date_id, product_id, region_id, channel_id, CAST(spend_chf AS DOUBLE) AS spend_chf, touchpoints
FROM fct_promo""", marts=False))
def q_src_csv_roundtrip(star):
    """Bulk load through CSV: write the promo fact as CSV with a header, then
    read it back with an explicit column list and types (no inference)."""
    p = star.fct_promo.select(*[f.name for f in PROMO_SCHEMA.fields])
    path = scratch_path(star.spark, "promo_csv")
    p.write.mode("overwrite").option("header", True).csv(path)
    return star.spark.read.schema(PROMO_SCHEMA).option("header", True).csv(path)


@star_query("surrogate_key", with_star("""
SELECT ROW_NUMBER() OVER (ORDER BY order_key, line_no, date_id, product_id, region_id, channel_id, units,
                                   gross_sales_chf) AS sales_id,
       order_key, line_no, date_id, CAST(gross_sales_chf AS DOUBLE) AS gross_sales_chf
FROM fct_sales""", marts=False))
def q_surrogate_key(star):
    """Serial keys over the sales fact, 1..n in business-key order on the first load.
    They are kept in a published key map: a later load keeps the keys given
    and numbers only new rows, after the largest one."""
    s = star.fct_sales.select("order_key", "line_no", "date_id", "product_id", "region_id", "channel_id",
                              "units", "gross_sales_chf")
    k = keys.KeyMap(star.warehouse.store("keys_fct_sales"), s.columns, "sales_id").keyed(s, star.lines_version["parts"])
    return k.select("sales_id", "order_key", "line_no", "date_id", "gross_sales_chf")


@star_query("seed_append", with_star(f"""
s AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{n}')" for i, n in enumerate(SEED_CHANNELS))}) t(ord, channel_name)),
n AS (SELECT * FROM s WHERE channel_name NOT IN (SELECT channel_name FROM dim_channel))
SELECT channel_id, channel_name FROM dim_channel
UNION ALL
SELECT CAST((SELECT COALESCE(max(channel_id), 0) FROM dim_channel) + ROW_NUMBER() OVER (ORDER BY ord) AS INTEGER),
       channel_name FROM n""", marts=False))
def q_seed_append(star):
    """Seed the channel dimension insert-if-absent (left anti on the name),
    new keys after the current maximum."""
    seed = star.spark.createDataFrame([(i, n) for i, n in enumerate(SEED_CHANNELS)], "_ord int, channel_name string")
    return keys.seed_append(star.dim_channel, seed, "channel_id", "channel_name")


@star_query("materialize_table", with_star("""
SELECT year, month, brand, canton, CAST(gross_sales_chf AS DOUBLE) AS gross_sales_chf,
       CAST(rebates_chf AS DOUBLE) AS rebates_chf, CAST(net_sales_chf AS DOUBLE) AS net_sales_chf
FROM mart_gtn_waterfall"""))
def q_materialize_table(star):
    """The GTN mart as a published table: a version per build, of which only the
    months that changed since the last one are rebuilt; readers see one version."""
    store = star.warehouse.store("mart_gtn_waterfall")
    month = lambda: month_of(F.make_date("year", "month", F.lit(1)))
    return store.read(derive(store, star.lines_version, lambda months: marts.mart_gtn_waterfall(star.of_months(months)), month))


@star_query("materialize_view", with_star(stg_sql("promo") + """
SELECT product_id, channel_id, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT(spend_chf) AS BIGINT) AS with_spend,
       CAST(SUM(spend_chf) AS DOUBLE) AS spend_chf FROM stg_promo GROUP BY product_id, channel_id""", marts=False))
def q_materialize_view(star):
    """A staging model behind a view, cleaned from the landed text whenever the
    view is read: spend by the cleaned keys, queried by the view's name."""
    register_views(star, ["stg_promo"])
    return star.spark.sql("SELECT product_id, channel_id, count(*) AS n_rows, count(spend_chf) AS with_spend, "
                          "sum(spend_chf) AS spend_chf FROM stg_promo GROUP BY product_id, channel_id")


CSV_SCHEMA = T.StructType([T.StructField("brand", T.StringType()), T.StructField("canton", T.StringType()),
                           T.StructField("net_sales", T.DoubleType())])


@star_query("export_csv", with_star("""
SELECT brand, canton, CAST(SUM(net_sales) AS DOUBLE) AS net_sales FROM exec_m GROUP BY brand, canton"""))
def q_export_csv(star):
    """Canton net totals per brand exported as CSV with a header and read
    back. Part files are written in parallel (no coalesce to one task)."""
    e = semantic.exec_monthly(star).groupBy("brand", "canton").agg(
        F.sum("net_sales").cast("double").alias("net_sales"))
    path = scratch_path(star.spark, "net_sales_by_canton_csv")
    e.write.mode("overwrite").option("header", True).csv(path)
    return star.spark.read.schema(CSV_SCHEMA).option("header", True).csv(path)


MARTS = {"mart_gtn_waterfall": marts.mart_gtn_waterfall, "mart_brand_perf": marts.mart_brand_perf,
         "mart_forecast_accuracy": marts.mart_forecast_accuracy}
MAX_ROWS = 5000


def register_views(star, names: list[str] | None = None) -> list[str]:
    """Temporary views of the warehouse under their own names: the star's tables, the
    marts, the raw tables as landed and the staging models (``stg_*``, ``*_raw``)."""
    makers = {t: (lambda t=t: getattr(star, t)) for t in CATALOG}
    makers |= {m: (lambda f=f: f(star)) for m, f in MARTS.items()}
    makers |= {f"stg_{w}": (lambda w=w: R.STAGING[w](R.raw_frame(star, w))) for w in R.STAGING}
    makers |= {f"{w}_raw": (lambda w=w: R.raw_frame(star, w)) for w in R.STAGING}
    for n in makers if names is None else names:
        makers[n]().createOrReplaceTempView(n)
    return sorted(makers)


def run_sql(star, statement: str, params: dict | None = None, max_rows: int = MAX_ROWS) -> DataFrame:
    """A user's statement over the warehouse's views with named parameters (``:name``,
    bound as values by Spark), capped at ``max_rows`` rows. Only views that the
    text names are registered; without an ORDER BY any rows may be the capped ones."""
    words = set(re.findall(r"\w+", statement))
    register_views(star, [n for n in [*CATALOG, *MARTS, *[f"stg_{w}" for w in R.STAGING], *[f"{w}_raw" for w in R.STAGING]] if n in words])
    return star.spark.sql(statement, args=params or {}).limit(max_rows)


@star_query("adhoc_sql_limit", with_star("""
SELECT year, month, brand, canton, CAST(gross_sales_chf AS DOUBLE) AS gross_sales_chf,
       CAST(rebates_chf AS DOUBLE) AS rebates_chf, CAST(net_sales_chf AS DOUBLE) AS net_sales_chf
FROM mart_gtn_waterfall WHERE net_sales_chf >= 1000 ORDER BY year, month, brand, canton LIMIT 100"""))
def q_adhoc_sql_limit(star):
    """A user SELECT with a parameter, capped at 100 rows (the statement carries a
    total ORDER BY, so the capped rows are determined)."""
    return run_sql(star, "SELECT * FROM mart_gtn_waterfall WHERE net_sales_chf >= :least ORDER BY year, month, brand, canton",
                   {"least": 1000}, max_rows=100)


HEAD_ORDER = ["date_id", "order_key", "line_no", "product_id", "region_id", "channel_id", "units",
              "gross_sales_chf"]


@star_query("table_head", with_star(f"""
SELECT order_key, line_no, date_id, product_id, region_id, channel_id, units,
       CAST(gross_sales_chf AS DOUBLE) AS gross_sales_chf
FROM fct_sales ORDER BY {', '.join(c + ' DESC' for c in HEAD_ORDER)} LIMIT 10""", marts=False))
def q_table_head(star):
    """``sample_rows(table, limit=10)``: newest rows first (distributed top-10)."""
    s = star.fct_sales.select("order_key", "line_no", "date_id", "product_id", "region_id", "channel_id",
                              "units", "gross_sales_chf")
    return s.orderBy(*[F.desc(c) for c in HEAD_ORDER]).limit(10)


CATALOG = ["dim_date", "dim_product", "dim_region", "dim_payer", "dim_channel", "fct_sales", "fct_rebates",
           "fct_promo", "fct_forecast"]


_TYPES = {  # column types of the star, as Spark names them
    "dim_date": {"date_id": "date", "year": "int", "month": "int", "week": "int", "month_start": "date", "week_start": "date"},
    "dim_product": {"product_id": "int", "brand": "string", "molecule": "string", "atc_code": "string", "indication": "string", "launch_date": "date"},
    "dim_region": {"region_id": "int", "canton": "string", "language_region": "string"},
    "dim_payer": {"payer_id": "bigint", "payer_name": "string", "payer_type": "string"},
    "dim_channel": {"channel_id": "int", "channel_name": "string"},
    "fct_sales": {"order_key": "bigint", "line_no": "int", "date_id": "date", "product_id": "int", "region_id": "int", "channel_id": "int",
                  "units": "int", "list_price_chf": "decimal(12,2)", "gross_sales_chf": "decimal(14,2)"},
    "fct_rebates": {"order_key": "bigint", "line_no": "int", "date_id": "date", "product_id": "int", "payer_id": "bigint", "region_id": "int",
                    "rebate_chf": "decimal(14,2)"},
    "fct_promo": {"order_key": "bigint", "line_no": "int", "date_id": "date", "product_id": "int", "region_id": "int", "channel_id": "int",
                  "spend_chf": "decimal(14,2)", "touchpoints": "int"},
    "fct_forecast": {"date_id": "date", "product_id": "int", "region_id": "int", "baseline_units": "decimal(12,2)", "uplift_units": "decimal(12,2)",
                     "forecast_units": "decimal(12,2)"},
}


@star_query("table_profile", with_star(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS data_type, CAST(COUNT(*) AS BIGINT) AS n_rows, "
    f"CAST(COUNT({c}) AS BIGINT) AS non_null, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS nulls, "
    f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, COUNT({c}) < COUNT(*) AS has_nulls, "
    f"COUNT(*) > 0 AND COUNT(DISTINCT {c}) = COUNT(*) AS is_key FROM {t}" for t, cols in _TYPES.items() for c, kind in cols.items()), marts=False))
def q_table_profile(star):
    """Overview of all tables of the star: type, rows, NULLs, least and greatest value,
    nullability and key flag of every column (the sketched distinct counts, which
    SQL can't repeat exactly, stay with ``profile.profiles``)."""
    return profiles({t: getattr(star, t) for t in CATALOG}).drop("approx_distinct")


@star_query("catalog_coverage", with_star(f"""
c AS ({' UNION ALL '.join(f"SELECT '{t}' AS table_name, COUNT(*) AS n FROM {t}" for t in CATALOG)})
SELECT CAST(COUNT(*) AS BIGINT) AS n_tables,
       CAST(COUNT(*) FILTER (WHERE starts_with(table_name, 'dim_')) AS BIGINT) AS n_dims,
       CAST(COUNT(*) FILTER (WHERE starts_with(table_name, 'fct_')) AS BIGINT) AS n_facts,
       CAST(SUM(n) FILTER (WHERE starts_with(table_name, 'dim_')) AS BIGINT) AS dim_rows,
       CAST(SUM(n) FILTER (WHERE starts_with(table_name, 'fct_')) AS BIGINT) AS fact_rows
FROM c""", marts=False))
def q_catalog_coverage(star):
    """Schema summary of the star: tables, dimensions and facts by name
    prefix, with their row counts."""
    parts = [getattr(star, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n")
             for t in CATALOG]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    dim, fact = F.col("table_name").startswith("dim_"), F.col("table_name").startswith("fct_")
    return u.agg(F.count(F.lit(1)).alias("n_tables"), F.count_if(dim).alias("n_dims"),
                 F.count_if(fact).alias("n_facts"), F.sum(F.when(dim, F.col("n"))).alias("dim_rows"),
                 F.sum(F.when(fact, F.col("n"))).alias("fact_rows"))


@star_query("month_spine", with_star("""
SELECT CAST(unnest(generate_series(CAST(date_trunc('month', max(date_id)) - INTERVAL 35 MONTH AS TIMESTAMP),
                                   CAST(date_trunc('month', max(date_id)) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month_start
FROM fct_sales""", marts=False))
def q_month_spine(star):
    """The 36 month starts ending with the month of the newest sale."""
    b = star.fct_sales.agg(F.max("date_id").alias("hi")).select(
        F.add_months(F.trunc("hi", "month"), -35).alias("lo"), "hi")
    return series.month_spine(b)
