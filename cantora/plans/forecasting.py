"""Registered forecasting queries and the parameter table (§2.7).

Frame -> features -> forecast -> metrics; OLS / WLS / bounded fits from moment
sums; grid search; per-scope fits; rolling-origin backtest. The DuckDB twins
are built from the same templates below so each oracle mirrors its operator.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cantora.functions.scalar import r6
from cantora.operators import forecast as fc
from cantora.operators import series
from cantora.operators.quantiles import group_quantiles
from cantora.plans.oracle_sql import R6, with_star
from cantora.plans.registry import star_query

# --------------------------------------------------------------------------
# SQL templates (DuckDB twins of operators.forecast)
# --------------------------------------------------------------------------
CAL_SQL = """
cal AS (
  SELECT make_date(p.year, p.month, 1) AS period, p.brand, p.canton,
         CAST(p.units AS DOUBLE) AS units, CAST(COALESCE(p.promo_spend, 0) AS DOUBLE) AS promo_spend,
         CASE WHEN g.g > 0 THEN CAST(g.r AS DOUBLE) / CAST(g.g AS DOUBLE) ELSE 0.0 END AS rebate_rate
  FROM mart_brand_perf p LEFT JOIN
       (SELECT year, month, brand, canton, SUM(gross_sales_chf) AS g, SUM(rebates_chf) AS r
        FROM mart_gtn_waterfall GROUP BY 1, 2, 3, 4) g
    ON p.year = g.year AND p.month = g.month AND p.brand = g.brand AND p.canton = g.canton
)"""


def feat_sql(name: str = "feat", lag: int = 0, src: str = "cal") -> str:
    promo = "promo_spend" if lag == 0 else \
        f"LAG(promo_spend, {lag}) OVER (PARTITION BY brand, canton ORDER BY period)"
    return f"""
{name}_0 AS (
  SELECT *, AVG(units) OVER (PARTITION BY brand, canton ORDER BY period
                             ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS baseline_units,
         {promo} AS promo_feat
  FROM {src}
),
{name} AS (SELECT *, rebate_rate * units AS rebate_pressure, units - baseline_units AS uplift_actual FROM {name}_0)"""


def fcst_expr(a: str, b: str) -> tuple[str, str]:
    up = (f"CASE WHEN ({a}) * promo_feat + ({b}) * rebate_pressure IS NULL THEN NULL ELSE "
          f"LEAST(GREATEST(({a}) * promo_feat + ({b}) * rebate_pressure, CAST(-0.4 AS DOUBLE) * units), "
          f"CAST(0.5 AS DOUBLE) * units) END")
    f = f"CASE WHEN baseline_units + ({up}) IS NULL THEN NULL ELSE GREATEST(0.0, baseline_units + ({up})) END"
    return up, f


def window_sql(name: str, group: list[str], src: str = "cal", hold_out: int = 0) -> str:
    g = ", ".join(group)
    sel = (g + ", ") if group else ""
    gb = f" GROUP BY {g}" if group else ""
    return f"""
{name} AS (
  SELECT {sel}GREATEST(min(period), CAST(max(period) - INTERVAL {12 + hold_out} MONTH AS DATE)) AS train_start,
         CAST(max(period) - INTERVAL {hold_out} MONTH AS DATE) AS train_end
  FROM {src}{gb}
)"""


def train_sql(name: str, feat: str, win: str, group: list[str]) -> str:
    on = " AND ".join(f"f.{c} = w.{c}" for c in group) if group else "TRUE"
    return f"""
{name} AS (
  SELECT f.* FROM {feat} f JOIN {win} w ON {on}
  WHERE f.period >= w.train_start AND f.period <= w.train_end
    AND f.baseline_units IS NOT NULL AND f.promo_feat IS NOT NULL
)"""


def moments_sql(name: str, train: str, group: list[str], weighted: bool = False) -> str:
    w = "GREATEST(units, 1.0)" if weighted else "1.0"
    sw = "sqrt(GREATEST(units, 1.0))" if weighted else "1.0"
    g = ", ".join(group)
    sel = (g + ", ") if group else ""
    gb = f" GROUP BY {g}" if group else ""
    return f"""
{name} AS (
  SELECT {sel}COUNT(*) AS n,
         SUM({w} * promo_feat * promo_feat) AS s11, SUM({w} * promo_feat * rebate_pressure) AS s12,
         SUM({w} * rebate_pressure * rebate_pressure) AS s22, SUM({w} * promo_feat * uplift_actual) AS s1y,
         SUM({w} * rebate_pressure * uplift_actual) AS s2y, SUM({w} * uplift_actual * uplift_actual) AS syy,
         MAX(GREATEST(abs(promo_feat * {sw}), abs(rebate_pressure * {sw}))) AS maxabs
  FROM {train}{gb}
)"""


def R9(x: str) -> str:
    return f"(floor(CAST({x} AS DOUBLE) * 1e9 + 0.5) / 1e9)"


FALLBACK = "(n < 6 OR maxabs IS NULL OR maxabs <= 1e-8)"
REGULAR = "(s11 * s22 > 0 AND s11 * s22 - s12 * s12 > 1e-14 * s11 * s22)"
OLS_A = f"CASE WHEN {REGULAR} THEN (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) ELSE s1y / NULLIF(s11 + s22, 0) END"
OLS_B = f"CASE WHEN {REGULAR} THEN (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) ELSE s2y / NULLIF(s11 + s22, 0) END"


def ols_sql(name: str, mom: str, group: list[str]) -> str:
    sel = (", ".join(group) + ", ") if group else ""
    return f"""
{name} AS (
  SELECT {sel}CAST(n AS BIGINT) AS n,
         CASE WHEN {FALLBACK} THEN 0.003 ELSE {R9(OLS_A)} END AS alpha,
         CASE WHEN {FALLBACK} THEN -0.5 ELSE {R9(OLS_B)} END AS beta,
         NOT {FALLBACK} AS ok
  FROM {mom}
)"""


def bounded_sql(name: str, mom: str, group: list[str]) -> str:
    sel = (", ".join(group) + ", ") if group else ""
    part = f"PARTITION BY {', '.join(group)} " if group else ""

    def sse(a, b):
        return (f"(syy - 2 * (({a}) * s1y + ({b}) * s2y) + ({a}) * ({a}) * s11 "
                f"+ 2 * ({a}) * ({b}) * s12 + ({b}) * ({b}) * s22)")
    be = "CASE WHEN s22 > 0 THEN LEAST(0.0, s2y / s22) ELSE 0.0 END"
    ae = "CASE WHEN s11 > 0 THEN GREATEST(0.0, s1y / s11) ELSE 0.0 END"
    return f"""
{name}_o AS (SELECT *, {OLS_A} AS oa, {OLS_B} AS ob FROM {mom}),
{name}_c AS (
  SELECT {sel}n, maxabs, 0 AS i, oa AS a, ob AS b, {sse('oa', 'ob')} AS e FROM {name}_o WHERE oa >= 0 AND ob <= 0
  UNION ALL SELECT {sel}n, maxabs, 1, 0.0, {be}, {sse('0.0', be)} FROM {name}_o
  UNION ALL SELECT {sel}n, maxabs, 2, {ae}, 0.0, {sse(ae, '0.0')} FROM {name}_o
  UNION ALL SELECT {sel}n, maxabs, 3, 0.0, 0.0, {sse('0.0', '0.0')} FROM {name}_o
),
{name} AS (
  SELECT {sel}CAST(n AS BIGINT) AS n,
         CASE WHEN {FALLBACK} THEN 0.003 ELSE {R9('a')} END AS alpha,
         CASE WHEN {FALLBACK} THEN -0.5 ELSE {R9('b')} END AS beta,
         NOT {FALLBACK} AS ok
  FROM (SELECT *, ROW_NUMBER() OVER ({part}ORDER BY e, i) AS rn FROM {name}_c) WHERE rn = 1
)"""


def metrics_sql(y: str = "units", yhat: str = "forecast_units") -> str:
    ok = f"({yhat} IS NOT NULL AND {y} IS NOT NULL)"
    den = f"(abs({y}) + abs({yhat}))"
    return (f"CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT(*) FILTER (WHERE NOT {ok}) AS BIGINT) AS null_forecasts, "
            f"{R6(f'AVG(CASE WHEN {ok} AND {y} > 0 THEN abs(({y} - {yhat}) / {y}) * 100.0 END)')} AS mape, "
            f"{R6(f'AVG(CASE WHEN {ok} AND {den} > 0 THEN 2.0 * abs({y} - {yhat}) / {den} * 100.0 END)')} AS smape, "
            f"{R6(f'CASE WHEN SUM(CASE WHEN {ok} THEN abs({y}) END) <> 0 THEN SUM(CASE WHEN {ok} THEN abs({y} - {yhat}) END) / SUM(CASE WHEN {ok} THEN abs({y}) END) * 100.0 END')} AS wape")


UP_DEF, FC_DEF = fcst_expr("CAST(0.003 AS DOUBLE)", "CAST(-0.5 AS DOUBLE)")
BASE = f"{CAL_SQL},{feat_sql()}"
GLOBAL_TRAIN = f"{BASE},{window_sql('win', [])},{train_sql('train', 'feat', 'win', [])}"
DEFAULT_FC_SQL = f"""
dfc AS (SELECT *, {UP_DEF} AS uplift_pred, {FC_DEF} AS forecast_units FROM feat)"""


# --------------------------------------------------------------------------
# Spark helpers shared by the queries
# --------------------------------------------------------------------------
def frame_of(star, many_uses: bool = False):
    """The calibration frame. When a query reads it for many scopes (three
    windows, three fits, ...) it is checkpointed (reliable, shared folder):
    its aggregates are built once instead of once per use. Within a
    query with a couple of uses, Spark's exchange reuse already shares the
    identical shuffles, and an eager checkpoint would only add a write."""
    frame = fc.calibration_frame(star)
    if many_uses:
        from cantora.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(star.spark)
        frame = frame.checkpoint()
    return frame


def features(star, promo_lag: int = 0):
    return fc.add_features(frame_of(star), promo_lag)


def default_forecast(star):
    return fc.forecast_with(features(star), F.lit(fc.DEFAULT_ALPHA), F.lit(fc.DEFAULT_BETA))


def global_train(star, promo_lag: int = 0):
    frame = frame_of(star)
    feats = fc.add_features(frame, promo_lag)
    return fc.train_rows(feats, fc.default_window(frame))


def group_train(star, group):
    frame = frame_of(star)
    feats = fc.add_features(frame)
    return fc.train_rows(feats, fc.default_window(frame, group), group)


FRAME_COLS = "period, brand, canton, units, promo_spend, rebate_rate"


@star_query("fc_frame", with_star(f"""{CAL_SQL}
SELECT {FRAME_COLS} FROM cal"""))
def q_fc_frame(star):
    """Calibration frame: units, promo spend and rebate rate per period x brand x canton."""
    return fc.calibration_frame(star)


@star_query("fc_baseline_uplift", with_star("""
SELECT date_id, product_id, region_id, CAST(baseline_units AS DOUBLE) AS baseline_units,
       CAST(uplift_units AS DOUBLE) AS uplift_units, CAST(forecast_units AS DOUBLE) AS forecast_units
FROM fct_forecast""", marts=False))
def q_fc_baseline_uplift(star):
    """Fact-grain forecast: previous-4-day baseline (0-filled) + clipped uplift."""
    return star.fct_forecast


@star_query("fc_features", with_star(f"""{BASE}
SELECT {FRAME_COLS}, baseline_units, promo_feat, rebate_pressure, uplift_actual FROM feat"""))
def q_fc_features(star):
    """``add_features(frame, promo_lag=0)``."""
    return features(star)


@star_query("fc_forecast", with_star(f"""{BASE},{DEFAULT_FC_SQL}
SELECT period, brand, canton, units, baseline_units, uplift_pred, forecast_units FROM dfc"""))
def q_fc_forecast(star):
    """``forecast_with_params(features, 0.003, -0.5)`` with clipping, NULL-propagating."""
    return default_forecast(star).select("period", "brand", "canton", "units", "baseline_units",
                                         "uplift_pred", "forecast_units")


SCOPE_FITS_SQL = f"""{BASE},
{window_sql('win_g', [])},{train_sql('tr_g', 'feat', 'win_g', [])},{moments_sql('mo_g', 'tr_g', [])},{ols_sql('p_g', 'mo_g', [])},
{window_sql('win_b', ['brand'])},{train_sql('tr_b', 'feat', 'win_b', ['brand'])},{moments_sql('mo_b', 'tr_b', ['brand'])},{ols_sql('p_b', 'mo_b', ['brand'])},
{window_sql('win_bc', ['brand', 'canton'])},{train_sql('tr_bc', 'feat', 'win_bc', ['brand', 'canton'])},{moments_sql('mo_bc', 'tr_bc', ['brand', 'canton'])},{ols_sql('p_bc', 'mo_bc', ['brand', 'canton'])}"""


def scope_fits(star):
    frame = frame_of(star, many_uses=True)
    feats = fc.add_features(frame)
    out = {}
    for name, group in (("global", ()), ("brand", ("brand",)), ("brand_canton", ("brand", "canton"))):
        tr = fc.train_rows(feats, fc.default_window(frame, group), group)
        out[name] = fc.fit(tr, "ols", group)
    return feats, out


@star_query("fc_forecast_by_scope", with_star(f"""{SCOPE_FITS_SQL},
s AS (
  SELECT f.*, COALESCE(bc.alpha, b.alpha, g.alpha) AS a, COALESCE(bc.beta, b.beta, g.beta) AS b,
         CASE WHEN bc.alpha IS NOT NULL THEN 'brand_canton' WHEN b.alpha IS NOT NULL THEN 'brand' ELSE 'global' END AS scope
  FROM feat f CROSS JOIN p_g g
  LEFT JOIN p_b b ON f.brand = b.brand
  LEFT JOIN p_bc bc ON f.brand = bc.brand AND f.canton = bc.canton
)
SELECT period, brand, canton, units, a AS alpha, b AS beta, scope,
       {fcst_expr('a', 'b')[1]} AS forecast_units
FROM s"""))
def q_fc_forecast_by_scope(star):
    """Forecast each series with the most specific saved parameters: brand x
    canton, else brand, else global (OLS fits of each scope's default window).
    Parameter tables have one row per scope key and are equi-joined; the
    global one is a single row (broadcast)."""
    feats, fits = scope_fits(star)
    g = fits["global"].select(F.col("alpha").alias("a_g"), F.col("beta").alias("b_g"))
    b = fits["brand"].select("brand", F.col("alpha").alias("a_b"), F.col("beta").alias("b_b"))
    bc = fits["brand_canton"].select("brand", "canton", F.col("alpha").alias("a_bc"),
                                     F.col("beta").alias("b_bc"))
    j = feats.crossJoin(F.broadcast(g)).join(b, "brand", "left").join(bc, ["brand", "canton"], "left")
    a = F.coalesce("a_bc", "a_b", "a_g")
    bb = F.coalesce("b_bc", "b_b", "b_g")
    scope = F.when(F.col("a_bc").isNotNull(), "brand_canton").when(F.col("a_b").isNotNull(), "brand") \
        .otherwise("global")
    out = fc.forecast_with(j.withColumns({"alpha": a, "beta": bb, "scope": scope}),
                           F.col("alpha"), F.col("beta"))
    return out.select("period", "brand", "canton", "units", "alpha", "beta", "scope", "forecast_units")


@star_query("fc_period_totals", with_star(f"""{BASE},{DEFAULT_FC_SQL}
SELECT period, {R6('COALESCE(SUM(units), 0)')} AS units, {R6('COALESCE(SUM(forecast_units), 0)')} AS forecast_units
FROM dfc GROUP BY period"""))
def q_fc_period_totals(star):
    """Units and forecast per period; a missing forecast counts as 0."""
    d = default_forecast(star)
    return d.groupBy("period").agg(r6(F.coalesce(F.sum("units"), F.lit(0.0))).alias("units"),
                                   r6(F.coalesce(F.sum("forecast_units"), F.lit(0.0))).alias("forecast_units"))


FIT_COLS = "n, alpha, beta, ok"


@star_query("fc_fit_ols", with_star(f"""{GLOBAL_TRAIN},{moments_sql('mo', 'train', [])},{ols_sql('p', 'mo', [])}
SELECT {FIT_COLS} FROM p"""))
def q_fc_fit_ols(star):
    """Global OLS fit of actual uplift on (promo, rebate pressure), no intercept."""
    return fc.fit(global_train(star), "ols")


@star_query("fc_fit_wls", with_star(f"""{GLOBAL_TRAIN},{moments_sql('mo', 'train', [], True)},{ols_sql('p', 'mo', [])}
SELECT {FIT_COLS} FROM p"""))
def q_fc_fit_wls(star):
    """Weighted least squares, rows weighted by sqrt(max(units, 1)) on X and y."""
    return fc.fit(global_train(star), "ols", weighted=True)


@star_query("fc_fit_bounded", with_star(f"""{GLOBAL_TRAIN},{moments_sql('mo', 'train', [])},{bounded_sql('p', 'mo', [])}
SELECT {FIT_COLS} FROM p"""))
def q_fc_fit_bounded(star):
    """Least squares with alpha >= 0 and beta <= 0 (exact bounded optimum)."""
    return fc.fit(global_train(star), "bounded")


def grid_sql(a_max=0.02, b_min=-1.0, steps=51, train="train", group=()) -> str:
    a_step, b_step = a_max / (steps - 1), (0.0 - b_min) / (steps - 1)
    g = ", ".join(group)
    sel = (g + ", ") if group else ""
    part = f"PARTITION BY {g} " if group else ""
    up, f = fcst_expr("gv.a", "gv.b")
    return f"""
gv AS (
  SELECT k, CASE WHEN k // {steps} = {steps - 1} THEN CAST({a_max!r} AS DOUBLE)
                 ELSE CAST(k // {steps} AS DOUBLE) * CAST({a_step!r} AS DOUBLE) END AS a,
            CASE WHEN k % {steps} = {steps - 1} THEN CAST(0.0 AS DOUBLE)
                 ELSE CAST(k % {steps} AS DOUBLE) * CAST({b_step!r} AS DOUBLE) + CAST({b_min!r} AS DOUBLE) END AS b
  FROM (SELECT range AS k FROM range(0, {steps * steps}))
),
ge AS (
  SELECT {sel}gv.k, {R9(f'AVG(CASE WHEN units > 0 THEN abs((units - ({f})) / units) * 100.0 END)')} AS err
  FROM {train} CROSS JOIN gv GROUP BY {sel}gv.k
),
gb AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER ({part}ORDER BY err, k) AS rn FROM ge WHERE err IS NOT NULL) WHERE rn = 1),
gn AS (SELECT {sel}COUNT(*) AS n FROM {train}{' GROUP BY ' + g if group else ''}),
grid AS (
  SELECT {', '.join('gn.' + c for c in group) + (', ' if group else '')}CAST(gn.n AS BIGINT) AS n,
         CASE WHEN gn.n < 6 OR gb.k IS NULL THEN 0.003
              WHEN gb.k // {steps} = {steps - 1} THEN CAST({a_max!r} AS DOUBLE)
              ELSE CAST(gb.k // {steps} AS DOUBLE) * CAST({a_step!r} AS DOUBLE) END AS alpha,
         CASE WHEN gn.n < 6 OR gb.k IS NULL THEN -0.5
              WHEN gb.k % {steps} = {steps - 1} THEN CAST(0.0 AS DOUBLE)
              ELSE CAST(gb.k % {steps} AS DOUBLE) * CAST({b_step!r} AS DOUBLE) + CAST({b_min!r} AS DOUBLE) END AS beta,
         gn.n >= 6 AS ok
  FROM gn LEFT JOIN gb ON {' AND '.join(f'gn.{c} = gb.{c}' for c in group) if group else 'TRUE'}
)"""


@star_query("fc_fit_grid", with_star(f"""{GLOBAL_TRAIN},{grid_sql()}
SELECT {FIT_COLS} FROM grid"""))
def q_fc_fit_grid(star):
    """Least train MAPE on the default 51 x 51 grid (a in [0, 0.02], b in [-1, 0])."""
    return fc.fit_grid(global_train(star))


@star_query("fc_fit_brand", with_star(f"""{BASE},{window_sql('w', ['brand'])},{train_sql('tr', 'feat', 'w', ['brand'])},{moments_sql('mo', 'tr', ['brand'])},{ols_sql('p', 'mo', ['brand'])}
SELECT brand, {FIT_COLS} FROM p"""))
def q_fc_fit_brand(star):
    """OLS per brand, every brand in one grouped aggregate (each brand with
    its own default window)."""
    return fc.fit(group_train(star, ("brand",)), "ols", ("brand",))


@star_query("fc_fit_brand_canton", with_star(f"""{BASE},{window_sql('w', ['brand', 'canton'])},{train_sql('tr', 'feat', 'w', ['brand', 'canton'])},{moments_sql('mo', 'tr', ['brand', 'canton'])},{ols_sql('p', 'mo', ['brand', 'canton'])}
SELECT brand, canton, {FIT_COLS} FROM p"""))
def q_fc_fit_brand_canton(star):
    """OLS per brand x canton, all series at once."""
    g = ("brand", "canton")
    return fc.fit(group_train(star, g), "ols", g)


@star_query("fc_train_window", with_star(f"""{CAL_SQL},{window_sql('wg', [])},{window_sql('wb', ['brand'])}
SELECT 'global' AS scope, '__GLOBAL__' AS scope_key, train_start, train_end FROM wg
UNION ALL SELECT 'brand', brand, train_start, train_end FROM wb"""))
def q_fc_train_window(star):
    """Default training window (last 12 month starts within the data) of the
    global scope and of every brand."""
    frame = frame_of(star)
    g = fc.default_window(frame).select(F.lit("global").alias("scope"),
                                        F.lit("__GLOBAL__").alias("scope_key"), "train_start", "train_end")
    b = fc.default_window(frame, ("brand",)).select(F.lit("brand").alias("scope"),
                                                    F.col("brand").alias("scope_key"), "train_start", "train_end")
    return g.unionByName(b)


@star_query("fc_promo_lag", with_star(f"""{CAL_SQL}
SELECT period, brand, canton, promo_spend, promo_spend AS promo_feat_lag0,
       LAG(promo_spend, 1) OVER (PARTITION BY brand, canton ORDER BY period) AS promo_feat_lag1
FROM cal"""))
def q_fc_promo_lag(star):
    """Promo feature at lag 0 and lag 1 month within each series."""
    return features(star, 1).select("period", "brand", "canton", "promo_spend",
                                    F.col("promo_spend").alias("promo_feat_lag0"),
                                    F.col("promo_feat").alias("promo_feat_lag1"))


def brand_metrics(star):
    d = default_forecast(star)
    return d.groupBy("brand").agg(*fc.metric_columns(F.col("units"), F.col("forecast_units")))


BRAND_METRICS_SQL = f"""{BASE},{DEFAULT_FC_SQL},
bm_x AS (SELECT brand, {metrics_sql()} FROM dfc GROUP BY brand)"""


for _key, _m in (("fc_mape", "mape"), ("fc_smape", "smape"), ("fc_wape", "wape")):
    def _q(star, _m=_m):
        return brand_metrics(star).select("brand", "rows", "null_forecasts", _m)
    _q.__doc__ = f"{_m.upper()} of the default forecast per brand (NULL forecasts skipped and counted)."
    star_query(_key, with_star(f"""{BRAND_METRICS_SQL}
SELECT brand, rows, null_forecasts, {_m} FROM bm_x"""))(_q)


VALID_MONTHS = 3


@star_query("fc_eval_train_valid", with_star(f"""{BASE},{window_sql('win', [], hold_out=VALID_MONTHS)},{train_sql('train', 'feat', 'win', [])},{moments_sql('mo', 'train', [])},{ols_sql('p', 'mo', [])},
ev AS (
  SELECT f.*, CASE WHEN f.period >= w.train_start AND f.period <= w.train_end THEN 'train'
                   WHEN f.period > w.train_end THEN 'valid' END AS split,
         {fcst_expr('p.alpha', 'p.beta')[1]} AS forecast_units
  FROM feat f CROSS JOIN win w CROSS JOIN p
)
SELECT split, {metrics_sql()} FROM ev WHERE split IS NOT NULL GROUP BY split"""))
def q_fc_eval_train_valid(star):
    """Rows, MAPE, SMAPE, WAPE on the training window and on the last three months,
    which the global OLS fit doesn't see (one-row parameter and window frames,
    broadcast)."""
    frame = frame_of(star)
    feats = fc.add_features(frame)
    win = fc.default_window(frame, hold_out=VALID_MONTHS)
    p = fc.fit(fc.train_rows(feats, win), "ols").select("alpha", "beta")
    j = feats.crossJoin(F.broadcast(win)).crossJoin(F.broadcast(p))
    split = F.when((F.col("period") >= F.col("train_start")) & (F.col("period") <= F.col("train_end")),
                   "train").when(F.col("period") > F.col("train_end"), "valid")
    ev = fc.forecast_with(j, F.col("alpha"), F.col("beta")).withColumn("split", split)
    return ev.filter(F.col("split").isNotNull()).groupBy("split").agg(
        *fc.metric_columns(F.col("units"), F.col("forecast_units")))


@star_query("fc_mae", with_star(f"""{BASE},{DEFAULT_FC_SQL}
SELECT brand, {R6('AVG(abs(units - forecast_units))')} AS mae FROM dfc GROUP BY brand"""))
def q_fc_mae(star):
    """Mean absolute error of the default forecast per brand."""
    d = default_forecast(star)
    return d.groupBy("brand").agg(r6(F.avg(F.abs(F.col("units") - F.col("forecast_units")))).alias("mae"))


@star_query("fc_rmse", with_star(f"""{BASE},{DEFAULT_FC_SQL}
SELECT brand, {R6('sqrt(AVG((units - forecast_units) * (units - forecast_units)))')} AS rmse FROM dfc GROUP BY brand"""))
def q_fc_rmse(star):
    """Root mean squared error of the default forecast per brand."""
    d = default_forecast(star)
    e = F.col("units") - F.col("forecast_units")
    return d.groupBy("brand").agg(r6(F.sqrt(F.avg(e * e))).alias("rmse"))


@star_query("fc_mase", with_star(f"""{BASE},{DEFAULT_FC_SQL},
mz AS (SELECT *, LAG(units) OVER (PARTITION BY brand, canton ORDER BY period) AS naive FROM dfc)
SELECT brand, canton, {R6('AVG(abs(units - forecast_units))')} AS mae,
       {R6('AVG(abs(units - naive))')} AS mae_naive,
       {R6('AVG(abs(units - forecast_units)) / NULLIF(AVG(abs(units - naive)), 0)')} AS mase
FROM mz GROUP BY brand, canton"""))
def q_fc_mase(star):
    """MAE / MAE of the last-value naive forecast on the same series."""
    d = default_forecast(star)
    w = series.w_series(["brand", "canton"], "period")
    z = d.withColumn("naive", F.lag("units").over(w))
    g = z.groupBy("brand", "canton").agg(
        F.avg(F.abs(F.col("units") - F.col("forecast_units"))).alias("_m"),
        F.avg(F.abs(F.col("units") - F.col("naive"))).alias("_n"))
    return g.select("brand", "canton", r6(F.col("_m")).alias("mae"), r6(F.col("_n")).alias("mae_naive"),
                    r6(F.try_divide(F.col("_m"), F.nullif(F.col("_n"), F.lit(0.0)))).alias("mase"))


@star_query("fc_ape", with_star(f"""{BASE},{DEFAULT_FC_SQL}
SELECT period, brand, canton, units, forecast_units,
       abs(units - forecast_units) / NULLIF(units, 0) AS ape FROM dfc"""))
def q_fc_ape(star):
    """Absolute percentage error (fraction) per row; NULL when units are 0."""
    d = default_forecast(star)
    return d.select("period", "brand", "canton", "units", "forecast_units",
                    F.try_divide(F.abs(F.col("units") - F.col("forecast_units")),
                                 F.nullif(F.col("units"), F.lit(0.0))).alias("ape"))


@star_query("fc_naive_seasonal", with_star(f"""{CAL_SQL}
SELECT a.period, a.brand, a.canton, a.units, b.units AS forecast_units,
       abs(a.units - b.units) / NULLIF(a.units, 0) AS ape
FROM cal a LEFT JOIN cal b ON b.brand = a.brand AND b.canton = a.canton
 AND b.period = CAST(a.period - INTERVAL 1 YEAR AS DATE)"""))
def q_fc_naive_seasonal(star):
    """Seasonal naive: the same month last year of the same series is the forecast."""
    c = fc.calibration_frame(star).select("period", "brand", "canton", "units")
    j = series.yoy(c, ["brand", "canton"], "period", "units", "forecast_units")
    return j.withColumn("ape", F.try_divide(F.abs(F.col("units") - F.col("forecast_units")),
                                            F.nullif(F.col("units"), F.lit(0.0))))


@star_query("fc_moving_average", with_star(f"""{CAL_SQL}
SELECT period, brand, canton, units,
       {R6('AVG(units) OVER (PARTITION BY brand, canton ORDER BY period ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)')} AS ma4,
       {R6('AVG(units) OVER (PARTITION BY brand, canton ORDER BY period ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)')} AS ma7,
       {R6('AVG(units) OVER (PARTITION BY brand, canton ORDER BY period ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)')} AS ma12
FROM cal"""))
def q_fc_moving_average(star):
    """Last-k mean forecasts (k = 4, 7, 12 previous periods) per series."""
    c = fc.calibration_frame(star).select("period", "brand", "canton", "units")
    w = series.w_series(["brand", "canton"], "period")
    return c.select("period", "brand", "canton", "units",
                    *[r6(F.avg("units").over(w.rowsBetween(-k, -1))).alias(f"ma{k}") for k in (4, 7, 12)])


@star_query("fc_backtest", with_star(f"""{BASE},
bt_p AS (
  SELECT period, COUNT(*) AS n, SUM(1.0 * promo_feat * promo_feat) AS s11, SUM(1.0 * promo_feat * rebate_pressure) AS s12,
         SUM(1.0 * rebate_pressure * rebate_pressure) AS s22, SUM(1.0 * promo_feat * uplift_actual) AS s1y,
         SUM(1.0 * rebate_pressure * uplift_actual) AS s2y, MAX(GREATEST(abs(promo_feat * 1.0), abs(rebate_pressure * 1.0))) AS maxabs
  FROM feat WHERE baseline_units IS NOT NULL AND promo_feat IS NOT NULL GROUP BY period
),
per AS (SELECT DISTINCT period FROM feat),
bt_c AS (
  SELECT per.period,
         COALESCE(SUM(p.n) OVER w, 0) AS n, SUM(p.s11) OVER w AS s11, SUM(p.s12) OVER w AS s12, SUM(p.s22) OVER w AS s22,
         SUM(p.s1y) OVER w AS s1y, SUM(p.s2y) OVER w AS s2y, MAX(p.maxabs) OVER w AS maxabs
  FROM per LEFT JOIN bt_p p ON per.period = p.period
  WINDOW w AS (ORDER BY per.period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
{ols_sql('bt_f', 'bt_c', ['period'])},
bt_s AS (SELECT f.*, q.alpha, q.beta, q.ok, {fcst_expr('q.alpha', 'q.beta')[1]} AS fcu FROM feat f JOIN bt_f q ON f.period = q.period)
SELECT period, alpha, beta, ok, {metrics_sql('units', 'fcu')} FROM bt_s GROUP BY period, alpha, beta, ok"""))
def q_fc_backtest(star):
    """Rolling origin, expanding window: for every period, OLS on all earlier
    periods' training rows, scored on that period. Per-period moment sums are
    accumulated with a running window over the (few) periods, so there is no
    loop over origins and no re-scan of the rows."""
    feats = features(star)
    tr = feats.na.drop(subset=["baseline_units", "promo_feat"])
    per_m = fc.moments(tr, ("period",))
    periods = feats.select("period").distinct()
    w = Window.orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    j = periods.join(per_m, "period", "left")
    cum = j.select("period", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("n"),
                   *[F.sum(c).over(w).alias(c) for c in ("s11", "s12", "s22", "s1y", "s2y", "syy")],
                   F.max("maxabs").over(w).alias("maxabs"))
    params = fc.solve(cum, "ols", ("period",)).drop("n")
    s = fc.forecast_with(feats.join(params, "period"), F.col("alpha"), F.col("beta"))
    return s.groupBy("period", "alpha", "beta", "ok").agg(
        *fc.metric_columns(F.col("units"), F.col("forecast_units")))


@star_query("fc_winsorize", with_star(f"""{BASE},
q AS (SELECT brand, quantile_cont(uplift_actual, 0.05) AS lo, quantile_cont(uplift_actual, 0.95) AS hi
      FROM feat WHERE uplift_actual IS NOT NULL GROUP BY brand)
SELECT f.period, f.brand, f.canton, f.uplift_actual,
       {R6('CASE WHEN f.uplift_actual IS NULL THEN NULL ELSE LEAST(GREATEST(f.uplift_actual, q.lo), q.hi) END')} AS uplift_winsor
FROM feat f JOIN q ON f.brand = q.brand"""))
def q_fc_winsorize(star):
    """Cap actual uplift to its 5th / 95th percentile per brand (exact
    percentiles; NULL stays NULL)."""
    f = features(star).select("period", "brand", "canton", "uplift_actual")
    q = group_quantiles(f, ["brand"], "uplift_actual", [0.05, 0.95]).select("brand", "q")
    j = f.join(q, "brand")
    from cantora.functions.scalar import clip
    return j.select("period", "brand", "canton", "uplift_actual",
                    r6(clip(F.col("uplift_actual"), F.col("q")[0], F.col("q")[1])).alias("uplift_winsor"))


@star_query("fc_promo_carryover", with_star(f"""{CAL_SQL}
SELECT period, brand, canton, promo_spend,
       {R6('promo_spend + 0.5 * COALESCE(LAG(promo_spend, 1) OVER w, 0) + 0.25 * COALESCE(LAG(promo_spend, 2) OVER w, 0) + 0.125 * COALESCE(LAG(promo_spend, 3) OVER w, 0)')} AS promo_adstock
FROM cal WINDOW w AS (PARTITION BY brand, canton ORDER BY period)"""))
def q_fc_promo_carryover(star):
    """Promo carry-over: Σ 0.5^k x spend at lag k, k = 0..3 (missing lags = 0)."""
    c = fc.calibration_frame(star).select("period", "brand", "canton", "promo_spend")
    w = series.w_series(["brand", "canton"], "period")
    ad = F.col("promo_spend")
    for k in (1, 2, 3):
        ad = ad + F.lit(0.5 ** k) * F.coalesce(F.lag("promo_spend", k).over(w), F.lit(0.0))
    return c.withColumn("promo_adstock", r6(ad))


SEASON_SQL = ("CASE WHEN month(period) IN (12, 1, 2) THEN 'winter' WHEN month(period) IN (3, 4, 5) THEN 'spring' "
              "WHEN month(period) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END")


def season(c):
    m = F.month(c)
    return F.when(m.isin(12, 1, 2), "winter").when(m.isin(3, 4, 5), "spring") \
        .when(m.isin(6, 7, 8), "summer").otherwise("autumn")


@star_query("fc_calendar_feats", with_star(f"""{CAL_SQL}
SELECT DISTINCT period, CAST(month(period) AS INTEGER) AS month, CAST(week(period) AS INTEGER) AS iso_week,
       CAST(quarter(period) AS INTEGER) AS quarter, {SEASON_SQL} AS season,
       month(period) IN (12, 1, 2) AS is_winter
FROM cal"""))
def q_fc_calendar_feats(star):
    """Calendar features of each period: month, ISO week, quarter, season flag."""
    p = fc.calibration_frame(star).select("period").distinct()
    return p.select("period", F.month("period").alias("month"), F.weekofyear("period").alias("iso_week"),
                    F.quarter("period").alias("quarter"), season(F.col("period")).alias("season"),
                    F.month("period").isin(12, 1, 2).alias("is_winter"))


@star_query("fc_interactions", with_star(f"""{BASE}
SELECT period, brand, canton,
       promo_feat * CASE WHEN month(period) IN (12, 1, 2) THEN 1.0 ELSE 0.0 END AS promo_x_winter,
       promo_feat * rebate_pressure AS promo_x_pressure,
       promo_feat * baseline_units AS promo_x_baseline,
       rebate_rate * CASE WHEN month(period) IN (12, 1, 2) THEN 1.0 ELSE 0.0 END AS rebate_x_winter
FROM feat"""))
def q_fc_interactions(star):
    """Crossed features: promo x season, promo x rebate pressure, promo x
    baseline, rebate rate x season."""
    f = features(star)
    winter = F.when(F.month("period").isin(12, 1, 2), 1.0).otherwise(0.0)
    return f.select("period", "brand", "canton",
                    (F.col("promo_feat") * winter).alias("promo_x_winter"),
                    (F.col("promo_feat") * F.col("rebate_pressure")).alias("promo_x_pressure"),
                    (F.col("promo_feat") * F.col("baseline_units")).alias("promo_x_baseline"),
                    (F.col("rebate_rate") * winter).alias("rebate_x_winter"))


@star_query("fc_price_elasticity", with_star(f"""
el AS (
  SELECT brand, canton, month_start, ln(CAST(units AS DOUBLE)) AS lu,
         ln(CAST(net AS DOUBLE) / CAST(units AS DOUBLE)) AS lp
  FROM canton_m WHERE units > 0 AND net > 0
),
d AS (SELECT brand, lu - LAG(lu) OVER w AS dlu, lp - LAG(lp) OVER w AS dlp FROM el
      WINDOW w AS (PARTITION BY brand, canton ORDER BY month_start))
SELECT brand, {R6('regr_slope(dlu, dlp)')} AS elasticity, CAST(regr_count(dlu, dlp) AS BIGINT) AS n
FROM d GROUP BY brand"""))
def q_fc_price_elasticity(star):
    """Price elasticity per brand: slope of Δln units on Δln ASP over
    consecutive months of each canton series (``regr_slope``)."""
    from cantora.operators import semantic
    c = semantic.canton_month(star).filter((F.col("units") > 0) & (F.col("net") > 0))
    e = c.select("brand", "canton", "month_start", F.ln(F.col("units").cast("double")).alias("lu"),
                 F.ln(F.col("net").cast("double") / F.col("units").cast("double")).alias("lp"))
    w = series.w_series(["brand", "canton"], "month_start")
    d = e.select("brand", (F.col("lu") - F.lag("lu").over(w)).alias("dlu"),
                 (F.col("lp") - F.lag("lp").over(w)).alias("dlp"))
    return d.groupBy("brand").agg(r6(F.regr_slope("dlu", "dlp")).alias("elasticity"),
                                  F.regr_count("dlu", "dlp").cast("bigint").alias("n"))
