"""Registered sort / limit / top-k / sampling / union queries.

Limits appear only where the limit is the feature (a head of an ordered
report, a top-N, a sample). ``orderBy(..).limit(n)`` plans as
TakeOrderedAndProject: each task keeps its own top n, the driver merges
n x tasks rows, so the cost stays bounded by n whatever the table size.
Every ordering is total (ties broken by the remaining keys) so that results
are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cantora.operators import semantic
from cantora.plans.oracle_sql import with_star
from cantora.plans.registry import star_query


@star_query("sort_multi", with_star("""
SELECT year, month, brand, canton, CAST(net_sales AS DOUBLE) AS net_sales
FROM exec_m ORDER BY year ASC, month ASC, net_sales DESC NULLS FIRST, brand ASC, canton ASC"""))
def q_sort_multi(star):
    """Multi-key ORDER BY, ascending and descending, NULL order explicit."""
    e = semantic.exec_monthly(star).select("year", "month", "brand", "canton", "net_sales")
    return e.orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month"),
                     F.desc_nulls_first("net_sales"), F.asc_nulls_last("brand"),
                     F.asc_nulls_last("canton"))


@star_query("limit_head", with_star("""
SELECT year, month, brand, canton, CAST(gross_sales AS DOUBLE) AS gross_sales,
       CAST(rebates AS DOUBLE) AS rebates, CAST(net_sales AS DOUBLE) AS net_sales
FROM exec_m ORDER BY year, month, brand, canton LIMIT 50"""))
def q_limit_head(star):
    """First 50 rows of the monthly overview in key order (the page head)."""
    e = semantic.exec_monthly(star).drop("month_start")
    return e.orderBy("year", "month", "brand", "canton").limit(50)


@star_query("topn_segments", with_star("""
seg AS (SELECT brand, canton, SUM(net_sales) AS net FROM exec_m GROUP BY brand, canton)
SELECT brand, canton, CAST(net AS DOUBLE) AS net,
       CAST(net AS DOUBLE) / CAST(SUM(net) OVER () AS DOUBLE) AS share
FROM seg ORDER BY net DESC, brand, canton LIMIT 20"""))
def q_topn_segments(star):
    """Top 20 brand x canton segments by net with their share of the total."""
    seg = semantic.exec_monthly(star).groupBy("brand", "canton").agg(F.sum("net_sales").alias("net"))
    tot = seg.agg(F.sum("net").alias("_tot"))
    s = seg.crossJoin(F.broadcast(tot)).select(
        "brand", "canton", "net",
        (F.col("net").cast("double") / F.col("_tot").cast("double")).alias("share"))
    return s.orderBy(F.desc_nulls_first("net"), "brand", "canton").limit(20)


@star_query("top_cantons", with_star("""
c AS (SELECT brand, canton, SUM(net_sales) AS net FROM exec_m GROUP BY brand, canton)
SELECT brand, canton, CAST(net AS DOUBLE) AS net, CAST(rn AS INTEGER) AS rank_in_brand FROM
  (SELECT *, ROW_NUMBER() OVER (PARTITION BY brand ORDER BY net DESC, canton) AS rn FROM c)
WHERE rn <= 5"""))
def q_top_cantons(star):
    """Top 5 cantons by net for every brand (per-group top-k on a brand x
    canton aggregate)."""
    c = semantic.exec_monthly(star).groupBy("brand", "canton").agg(F.sum("net_sales").alias("net"))
    w = Window.partitionBy("brand").orderBy(F.desc_nulls_first("net"), F.asc("canton"))
    return c.withColumn("rank_in_brand", F.row_number().over(w)).filter("rank_in_brand <= 5")


@star_query("topn_context", with_star("""
b AS (SELECT r.language_region, e.brand, SUM(e.net_sales) AS net
      FROM exec_m e JOIN dim_region r ON e.canton = r.canton GROUP BY 1, 2),
t AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY language_region ORDER BY net DESC, brand) AS rn FROM b)
SELECT language_region, brand, CAST(net AS DOUBLE) AS net, CAST(rn AS INTEGER) AS rnk FROM t WHERE rn <= 5"""))
def q_topn_context(star):
    """Top 5 brands by net taken *after* the context filter (language
    region), for every language region at once."""
    e = semantic.exec_monthly(star)
    r = star.dim_region.select("canton", "language_region")
    b = e.join(r, "canton").groupBy("language_region", "brand").agg(F.sum("net_sales").alias("net"))
    w = Window.partitionBy("language_region").orderBy(F.desc_nulls_first("net"), F.asc("brand"))
    return b.withColumn("rnk", F.row_number().over(w)).filter("rnk <= 5")


SAMPLE_SEED = "7"


def sample_rows(df, n: int, seed: str, key_cols: list[str]):
    """``n`` rows without replacement, repeatable: order by md5(seed || key)
    and take n (a distributed top-n)."""
    h = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in key_cols]))
    return df.withColumn("_h", h).orderBy("_h", *key_cols).limit(n).drop("_h")


@star_query("sample_n", with_star("""
SELECT region_id, canton, language_region FROM dim_region
ORDER BY md5(concat_ws('|', '7', CAST(region_id AS VARCHAR))), region_id LIMIT 12"""))
def q_sample_n(star):
    """12 regions sampled without replacement with a fixed seed."""
    return sample_rows(star.dim_region, 12, SAMPLE_SEED, ["region_id"])


@star_query("union_all", with_star("""
SELECT date_id, product_id, region_id, 'sales' AS measure, CAST(gross_sales_chf AS DOUBLE) AS amount FROM fct_sales
UNION ALL
SELECT date_id, product_id, region_id, 'rebate' AS measure, CAST(rebate_chf AS DOUBLE) AS amount FROM fct_rebates
UNION ALL
SELECT date_id, product_id, region_id, 'promo' AS measure, CAST(spend_chf AS DOUBLE) AS amount FROM fct_promo""",
    marts=False))
def q_union_all(star):
    """The three money facts stacked (duplicates kept), tagged by measure."""
    cols = ["date_id", "product_id", "region_id"]
    s = star.fct_sales.select(*cols, F.lit("sales").alias("measure"),
                              F.col("gross_sales_chf").alias("amount"))
    r = star.fct_rebates.select(*cols, F.lit("rebate").alias("measure"),
                                F.col("rebate_chf").alias("amount"))
    p = star.fct_promo.select(*cols, F.lit("promo").alias("measure"),
                              F.col("spend_chf").alias("amount"))
    return s.unionByName(r).unionByName(p)
