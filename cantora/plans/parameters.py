"""Registered parameter-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cantora.operators import forecast as fc
from cantora.operators import params as P
from cantora.plans.forecasting import SCOPE_FITS_SQL, moments_sql, ols_sql
from cantora.plans.oracle_sql import with_star
from cantora.plans.registry import star_query
from cantora.session import scratch_path
from cantora.sources.store import Store

# Version stamps of the two parameter saves in the registered example.
T1 = "2025-01-01 00:00:00"
T2 = "2025-01-02 00:00:00"


@star_query("params_canonical_keys", with_star("""
SELECT 'global' AS scope_level, '__GLOBAL__' AS scope_key1, '__GLOBAL__' AS scope_key2
UNION ALL SELECT DISTINCT 'brand', brand, '__ALL__' FROM mart_brand_perf
UNION ALL SELECT DISTINCT 'brand_canton', brand, canton FROM mart_brand_perf"""))
def q_params_canonical_keys(star):
    """Canonical (key1, key2) of every scope present in the data: global,
    each brand, each brand x canton (no NULLs in the primary key)."""
    from cantora.plans import marts
    m = marts.mart_brand_perf(star).select("brand", "canton").distinct()
    g = m.limit(1).select(F.lit("global").alias("scope_level"), F.lit(None).cast("string").alias("k1"),
                          F.lit(None).cast("string").alias("k2"))
    b = m.select(F.lit("brand").alias("scope_level"), F.col("brand").alias("k1"),
                 F.lit(None).cast("string").alias("k2")).distinct()
    bc = m.select(F.lit("brand_canton").alias("scope_level"), F.col("brand").alias("k1"),
                  F.col("canton").alias("k2"))
    u = g.unionByName(b).unionByName(bc)
    k1, k2 = P.canonical_keys(F.col("scope_level"), F.col("k1"), F.col("k2"))
    return u.select("scope_level", k1.alias("scope_key1"), k2.alias("scope_key2"))


def _versions(star):
    from cantora.plans.forecasting import frame_of
    frame = frame_of(star, many_uses=True)
    feats = fc.add_features(frame)
    rows = []
    for level, group, weighted, stamp, method in (
            ("global", (), False, T1, "OLS"), ("brand", ("brand",), False, T1, "OLS"),
            ("brand_canton", ("brand", "canton"), False, T1, "OLS"),
            ("global", (), True, T2, "WLS"), ("brand", ("brand",), True, T2, "WLS")):
        win = fc.default_window(frame, group)
        fit = fc.fit(fc.train_rows(feats, win, group), "ols", group, weighted)
        j = fit.join(win, list(group)) if group else fit.crossJoin(win)
        k1 = F.col("brand") if "brand" in group else F.lit(None).cast("string")
        k2 = F.col("canton") if "canton" in group else F.lit(None).cast("string")
        c1, c2 = P.canonical_keys(F.lit(level), k1, k2)
        rows.append(j.select(F.lit(level).alias("scope_level"), c1.alias("scope_key1"), c2.alias("scope_key2"),
                             "alpha", "beta", "train_start", "train_end",
                             F.lit(stamp).cast("timestamp_ntz").alias("updated_at"),
                             F.lit(method).alias("fit_method"), F.lit(0).alias("promo_lag")))
    return rows


VERSIONS_SQL = f"""{SCOPE_FITS_SQL},
{moments_sql('mw_g', 'tr_g', [], True)},{ols_sql('pw_g', 'mw_g', [])},
{moments_sql('mw_b', 'tr_b', ['brand'], True)},{ols_sql('pw_b', 'mw_b', ['brand'])},
v AS (
  SELECT 'global' AS scope_level, '__GLOBAL__' AS scope_key1, '__GLOBAL__' AS scope_key2, alpha, beta,
         train_start, train_end, TIMESTAMP '{T1}' AS updated_at, 'OLS' AS fit_method, 0 AS promo_lag
  FROM p_g CROSS JOIN win_g
  UNION ALL SELECT 'brand', p.brand, '__ALL__', alpha, beta, train_start, train_end, TIMESTAMP '{T1}', 'OLS', 0
  FROM p_b p JOIN win_b w ON p.brand = w.brand
  UNION ALL SELECT 'brand_canton', p.brand, p.canton, alpha, beta, train_start, train_end, TIMESTAMP '{T1}', 'OLS', 0
  FROM p_bc p JOIN win_bc w ON p.brand = w.brand AND p.canton = w.canton
  UNION ALL SELECT 'global', '__GLOBAL__', '__GLOBAL__', alpha, beta, train_start, train_end, TIMESTAMP '{T2}', 'WLS', 0
  FROM pw_g CROSS JOIN win_g
  UNION ALL SELECT 'brand', p.brand, '__ALL__', alpha, beta, train_start, train_end, TIMESTAMP '{T2}', 'WLS', 0
  FROM pw_b p JOIN win_b w ON p.brand = w.brand
),
newest AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY scope_level, scope_key1, scope_key2
                                              ORDER BY updated_at DESC, fit_method DESC, alpha DESC, beta DESC) AS rn
                 FROM v) WHERE rn = 1
)"""


@star_query("params_upsert", with_star(f"""{VERSIONS_SQL}
SELECT scope_level, scope_key1, scope_key2, alpha, beta, train_start, train_end, updated_at, fit_method,
       CAST(promo_lag AS INTEGER) AS promo_lag FROM newest"""))
def q_params_upsert(star):
    """Two saves of fitted parameters (OLS at every scope, then WLS at the
    global and brand scopes) upserted on the three-part key: the newest version
    wins. Both are commits of a versioned table, which is read back."""
    return _saved(star).rows()


def _saved(star) -> P.ParamTable:
    v = _versions(star)
    table = P.ParamTable(Store(star.spark, scratch_path(star.spark, "forecast_params")))
    table.save(v[0].unionByName(v[1]).unionByName(v[2]))
    table.save(v[3].unionByName(v[4]))
    return table


@star_query("params_lookup", with_star(f"""{VERSIONS_SQL}
SELECT scope_key1 AS brand, alpha, beta, fit_method, updated_at FROM newest WHERE scope_level = 'brand'"""))
def q_params_lookup(star):
    """``load_saved_params('brand', b)`` for every brand of the mart: the newest
    saved row of each brand scope, read from the parameter table."""
    from cantora.plans import marts
    brands = marts.mart_brand_perf(star).select(F.lit("brand").alias("scope_level"), F.col("brand").alias("k1"), F.lit(None).cast("string").alias("k2"))
    found = P.lookup_each(_saved(star).rows(), brands)
    return found.select(F.col("scope_key1").alias("brand"), "alpha", "beta", "fit_method", "updated_at")
