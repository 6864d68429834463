"""Causal baseline-plus-uplift forecast: derivation, features, fits, metrics.

Model: ``forecast = max(0, baseline + clip(a*promo + b*rebate_rate*units,
-0.4*units, 0.5*units))`` where ``baseline`` is the mean of the previous four
periods of the same series.

Everything is an aggregate or window expression. Fits reduce the training
rows to a handful of moment sums in one aggregation (map-side partial sums, so a
hot brand costs nothing extra) and solve the 2x2 system in column expressions;
only the per-group (alpha, beta) rows are ever produced. Windows are partitioned
by series (brand x canton, or product x region at day grain), whose length is
bounded by the number of periods, not by the number of fact rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantora.functions.scalar import cents, clip, max0
from cantora.session import scratch_path

# Fixed values of the reference's forecast.
DEFAULT_ALPHA = 0.003
DEFAULT_BETA = -0.5
UPLIFT_FLOOR = -0.4
UPLIFT_CAP = 0.5
BASELINE_WINDOW = 4
MIN_FIT_ROWS = 6
ALLCLOSE_ATOL = 1e-8

SERIES = ["brand", "canton"]


# --------------------------------------------------------------------------
# fact-grain derivation (the forecast fact of the star)
# --------------------------------------------------------------------------
def uplift_expr(a: Column, promo: Column, b: Column, pressure: Column,
                units: Column) -> Column:
    """``clip(a*promo + b*pressure, -0.4*units, 0.5*units)``, NULL-propagating."""
    raw = a * promo + b * pressure
    return clip(raw, F.lit(UPLIFT_FLOOR) * units, F.lit(UPLIFT_CAP) * units)


def baseline_uplift_fact(fct_sales: DataFrame, fct_rebates: DataFrame,
                         fct_promo: DataFrame) -> DataFrame:
    """Forecast fact per date x product x region from the three other facts:
    units and gross summed per key, rebates and promo left-joined (0 if none),
    rebate rate (0 when gross <= 0), baseline = mean of the previous four days
    of the series (0 when none), uplift with the default (alpha, beta)."""
    keys = ["date_id", "product_id", "region_id"]
    s = fct_sales.groupBy(*keys).agg(F.sum("units").alias("units_total"),
                                     F.sum("gross_sales_chf").alias("gross"))
    r = fct_rebates.groupBy(*keys).agg(F.sum("rebate_chf").alias("rebate_chf"))
    p = fct_promo.groupBy(*keys).agg(F.sum("spend_chf").alias("spend_chf"))
    m = s.join(r, keys, "left").join(p, keys, "left")
    rebate = F.coalesce(F.col("rebate_chf").cast("double"), F.lit(0.0))
    spend = F.coalesce(F.col("spend_chf").cast("double"), F.lit(0.0))
    units = F.col("units_total").cast("double")
    rate = F.when(F.col("gross") > 0, rebate / F.col("gross").cast("double")).otherwise(0.0)
    w = Window.partitionBy("product_id", "region_id").orderBy("date_id") \
        .rowsBetween(-BASELINE_WINDOW, -1)
    base = F.coalesce(F.avg(units).over(w), F.lit(0.0))
    m = m.select(*keys, units.alias("u"), spend.alias("sp"), rate.alias("rr"),
                 base.alias("bl"))
    up = uplift_expr(F.lit(DEFAULT_ALPHA), F.col("sp"), F.lit(DEFAULT_BETA),
                     F.col("rr") * F.col("u"), F.col("u"))
    m = m.withColumn("up", up)
    return m.select(
        *keys,
        cents(F.col("bl")).alias("baseline_units"),
        cents(F.col("up")).alias("uplift_units"),
        cents(max0(F.col("bl") + F.col("up"))).alias("forecast_units"),
    )


# --------------------------------------------------------------------------
# calibration frame and features (month grain, series = brand x canton)
# --------------------------------------------------------------------------
def calibration_frame(star) -> DataFrame:
    """period, brand, canton, units, promo_spend, rebate_rate (doubles), from one
    aggregate of each fact; rebate rate 0 when gross <= 0 or missing."""
    from cantora.operators.semantic import canton_month
    m = canton_month(star)
    rr = F.when(F.col("gross") > 0, F.col("rebates").cast("double") / F.col("gross").cast("double")).otherwise(0.0)
    return m.select(F.col("month_start").alias("period"), "brand", "canton",
                    F.col("units").cast("double").alias("units"),
                    F.col("promo").cast("double").alias("promo_spend"),
                    rr.alias("rebate_rate"))


def add_features(frame: DataFrame, promo_lag: int = 0, group_cols=SERIES) -> DataFrame:
    """baseline (mean of the previous 4 periods, at least 1), promo feature
    (promo spend lagged ``promo_lag`` periods in the series), rebate pressure
    (rate x units), actual uplift (units - baseline)."""
    w = Window.partitionBy(*group_cols).orderBy(F.col("period").asc_nulls_last())
    base = F.avg("units").over(w.rowsBetween(-BASELINE_WINDOW, -1))
    promo = F.col("promo_spend") if promo_lag == 0 else F.lag("promo_spend", promo_lag).over(w)
    out = frame.withColumns({"baseline_units": base, "promo_feat": promo})
    return out.withColumns({
        "rebate_pressure": F.col("rebate_rate") * F.col("units"),
        "uplift_actual": F.col("units") - F.col("baseline_units")})


def forecast_with(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """uplift_pred = clip(a*promo + b*pressure, -0.4u, 0.5u);
    forecast = max(0, baseline + uplift_pred). NULL in, NULL out."""
    up = uplift_expr(a, F.col("promo_feat"), b, F.col("rebate_pressure"), F.col("units"))
    return df.withColumn("uplift_pred", up).withColumn(
        "forecast_units", max0(F.col("baseline_units") + F.col("uplift_pred")))


def default_window(frame: DataFrame, group_cols=(), hold_out: int = 0) -> DataFrame:
    """Default training window per scope: from max(first period, last period
    - 12 months) to the last period. With ``hold_out`` the last so many months stay
    after the window, for validation."""
    g = frame.groupBy(*group_cols) if group_cols else frame.groupBy()
    b = g.agg(F.min("period").alias("_pmin"), F.add_months(F.max("period"), -hold_out).alias("_pmax"))
    return b.select(*group_cols,
                    F.greatest("_pmin", F.add_months("_pmax", -12)).alias("train_start"),
                    F.col("_pmax").alias("train_end"))


def train_rows(feats: DataFrame, window: DataFrame, group_cols=()) -> DataFrame:
    """Rows inside the scope's window with a baseline and a promo feature.
    The window frame has one row per scope (joined on the scope keys, or
    broadcast when the scope is global: one row)."""
    if group_cols:
        j = feats.join(window, list(group_cols))
    else:
        j = feats.crossJoin(F.broadcast(window))
    j = j.filter((F.col("period") >= F.col("train_start")) & (F.col("period") <= F.col("train_end")))
    return j.na.drop(subset=["baseline_units", "promo_feat"])


def exact_sums(df: DataFrame, group_cols, sums: dict[str, Column], others: list[Column]) -> DataFrame:
    """Per group the sums of double terms, whatever the order and partitions of the
    rows, with ``others`` (aggregates that don't depend on order).

    Every term is rounded to a multiple of a power of two, 2^-52 of the group's
    largest term (one aggregate); the multiples are whole numbers, whose decimal sum
    is exact. The error per term is that of adding it to the largest one once."""
    keys = list(group_cols)
    t = df.select(*df.columns, *[c.cast("double").alias(f"_t_{n}") for n, c in sums.items()])
    path = scratch_path(df.sparkSession, "terms")
    t.write.parquet(path)
    t = df.sparkSession.read.parquet(path)
    largest = t.groupBy(*keys).agg(*[F.max(F.abs(f"_t_{n}")).alias(f"_m_{n}") for n in sums])
    unit = {n: F.when(F.col(f"_m_{n}") > 0, F.pow(F.lit(2.0), F.greatest(F.ceil(F.log2(f"_m_{n}")) - 52, F.lit(-1000)))).otherwise(F.lit(1.0)) for n in sums}
    if keys:
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        j = t.join(largest.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[unit[n].alias(f"_u_{n}") for n in sums]), on)
    else:
        j = t.crossJoin(F.broadcast(largest.select(*[unit[n].alias(f"_u_{n}") for n in sums])))   # one row
    whole = {n: F.sum(F.rint(F.col(f"_t_{n}") / F.col(f"_u_{n}")).cast("decimal(38,0)")) for n in sums}
    return j.groupBy(*keys).agg(*others, *[(whole[n].cast("double") * F.max(f"_u_{n}")).alias(n) for n in sums])


def moments(train: DataFrame, group_cols=(), weighted: bool = False) -> DataFrame:
    """Moment sums of the two-feature, no-intercept regression: n, Σx1², Σx1x2,
    Σx2², Σx1y, Σx2y, Σy² (``exact_sums``: the same for any partitioning), and
    max|x| for the all-zero test. WLS multiplies X and y by sqrt(max(units, 1)),
    i.e. weights the products by max(units, 1)."""
    x1, x2, y = F.col("promo_feat"), F.col("rebate_pressure"), F.col("uplift_actual")
    w = F.greatest(F.col("units"), F.lit(1.0)) if weighted else F.lit(1.0)
    sw = F.sqrt(w) if weighted else F.lit(1.0)
    narrow = train.select(*group_cols, "promo_feat", "rebate_pressure", "uplift_actual", "units")
    return exact_sums(narrow, group_cols, {"s11": w * x1 * x1, "s12": w * x1 * x2, "s22": w * x2 * x2, "s1y": w * x1 * y, "s2y": w * x2 * y, "syy": w * y * y},
                      [F.count(F.lit(1)).alias("n"), F.max(F.greatest(F.abs(x1 * sw), F.abs(x2 * sw))).alias("maxabs")])


def r9(x: Column) -> Column:
    """Half-up to 9 places with IEEE operations (fitted parameters)."""
    return F.when(x.isNotNull(), F.floor(x * 1e9 + 0.5).cast("double") / 1e9)


def _fallback(m: Column | None = None) -> Column:
    return (F.col("n") < MIN_FIT_ROWS) | F.col("maxabs").isNull() | (F.col("maxabs") <= ALLCLOSE_ATOL)


def ols_columns() -> tuple[Column, Column]:
    """Least-squares (alpha, beta) from moment sums; minimum-norm answer when
    the 2x2 system is singular (collinear or zero columns)."""
    s11, s12, s22, s1y, s2y = (F.col(c) for c in ("s11", "s12", "s22", "s1y", "s2y"))
    det = s11 * s22 - s12 * s12
    regular = (s11 * s22 > 0) & (det > F.lit(1e-14) * s11 * s22)
    td = F.try_divide
    a = F.when(regular, td(s22 * s1y - s12 * s2y, det)).otherwise(td(s1y, s11 + s22))
    b = F.when(regular, td(s11 * s2y - s12 * s1y, det)).otherwise(td(s2y, s11 + s22))
    return a, b


def solve(m: DataFrame, method: str = "ols", group_cols=()) -> DataFrame:
    """alpha, beta, ok per group from moment sums. ``ols`` (also WLS when the
    moments are weighted) or ``bounded`` (alpha >= 0, beta <= 0: the least-SSE
    of interior-if-feasible, alpha=0 edge, beta=0 edge and the corner)."""
    a, b = ols_columns()
    if method == "bounded":
        s11, s12, s22, s1y, s2y, syy = (F.col(c) for c in ("s11", "s12", "s22", "s1y", "s2y", "syy"))

        def sse(x, y):
            return syy - 2 * (x * s1y + y * s2y) + x * x * s11 + 2 * x * y * s12 + y * y * s22

        zero = F.lit(0.0)
        b_edge = F.when(s22 > 0, F.least(zero, F.try_divide(s2y, s22))).otherwise(zero)
        a_edge = F.when(s11 > 0, F.greatest(zero, F.try_divide(s1y, s11))).otherwise(zero)
        cands = [
            F.when((a >= 0) & (b <= 0), F.struct(sse(a, b).alias("e"), F.lit(0).alias("i"),
                                                 a.alias("a"), b.alias("b"))),
            F.struct(sse(zero, b_edge).alias("e"), F.lit(1).alias("i"), zero.alias("a"), b_edge.alias("b")),
            F.struct(sse(a_edge, zero).alias("e"), F.lit(2).alias("i"), a_edge.alias("a"), zero.alias("b")),
            F.struct(sse(zero, zero).alias("e"), F.lit(3).alias("i"), zero.alias("a"), zero.alias("b")),
        ]
        best = F.least(*cands)
        a, b = best["a"], best["b"]
    fb = _fallback()
    return m.select(
        *group_cols, "n",
        F.when(fb, F.lit(DEFAULT_ALPHA)).otherwise(r9(a)).alias("alpha"),
        F.when(fb, F.lit(DEFAULT_BETA)).otherwise(r9(b)).alias("beta"),
        (~fb).alias("ok"))


def fit(train: DataFrame, method: str = "ols", group_cols=(), weighted: bool = False) -> DataFrame:
    return solve(moments(train, group_cols, weighted), method, group_cols)


# grid columns that one row's aggregates cover
GRID_COLUMNS = 3


def fit_grid(train: DataFrame, a_max: float = 0.02, b_min: float = -1.0, steps: int = 51,
             group_cols=()) -> DataFrame:
    """Least train MAPE over an a x b grid (np.linspace points built from the
    integer index). A training row becomes one row a grid row and block of
    columns, whose errors are the aggregates' columns: each task keeps the
    partial sums of the whole grid as a few wide rows per group, merged like any
    other partial aggregate, instead of steps^2 rows per training row. The
    arg-min keeps the first point in (a, b) order among equal errors (errors
    rounded to 9 places first)."""
    a_step, b_step = a_max / (steps - 1), (0.0 - b_min) / (steps - 1)
    ia = F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("ia")
    # few bytes, steps^2 times the work: without this they are put together in one task
    spread = train.repartition(int(train.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    x = spread.select(*group_cols, "promo_feat", "rebate_pressure", "baseline_units", "units", ia)
    a = F.when(F.col("ia") == steps - 1, F.lit(float(a_max))).otherwise(F.col("ia").cast("double") * a_step)
    act = F.col("units")
    x = x.select(*group_cols, "ia", "rebate_pressure", "baseline_units", "units", (a * F.col("promo_feat")).alias("_a"),
                 (F.lit(UPLIFT_FLOOR) * act).alias("_lo"), (F.lit(UPLIFT_CAP) * act).alias("_hi"))
    firsts = list(range(0, steps, GRID_COLUMNS))
    x = x.select("*", F.explode(F.array(*[F.lit(i) for i in firsts])).alias("ib0"))

    def point(c: int) -> Column:
        ib = F.col("ib0") + c
        b = F.when(ib == steps - 1, F.lit(0.0)).otherwise(ib.cast("double") * b_step + b_min)
        up = clip(F.col("_a") + b * F.col("rebate_pressure"), F.col("_lo"), F.col("_hi"))
        return F.when(act > 0, F.abs((act - max0(F.col("baseline_units") + up)) / act) * 100.0)

    wide = x.groupBy(*group_cols, "ia", "ib0").agg(*[F.avg(point(c)).alias(f"_e{c}") for c in range(GRID_COLUMNS)])
    points = F.array(*[F.struct((F.col("ia") * steps + F.col("ib0") + c).alias("k"), r9(F.col(f"_e{c}")).alias("err"), (F.col("ib0") + c).alias("ib"))
                       for c in range(GRID_COLUMNS)])
    per_pt = wide.select(*group_cols, F.explode(points).alias("_p")).where(F.col("_p.ib") < steps).select(*group_cols, "_p.k", "_p.err")
    gk = per_pt.groupBy(*group_cols) if group_cols else per_pt.groupBy()
    best = gk.agg(F.min(F.struct(F.col("err"), F.col("k"))).alias("best"),
                  F.count("err").alias("_has"))
    rows = train.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n")) if group_cols else \
        train.agg(F.count(F.lit(1)).alias("n"))
    j = rows.join(best, list(group_cols), "left") if group_cols else rows.crossJoin(best)
    kb = F.col("best.k")
    ba = F.when((kb / steps).cast("int") == steps - 1, F.lit(float(a_max))) \
        .otherwise((kb / steps).cast("int").cast("double") * a_step)
    bb = F.when(kb % steps == steps - 1, F.lit(0.0)).otherwise((kb % steps).cast("double") * b_step + b_min)
    few = F.col("n") < MIN_FIT_ROWS
    no_err = F.coalesce(F.col("_has"), F.lit(0)) == 0
    return j.select(
        *group_cols, "n",
        F.when(few | no_err, F.lit(DEFAULT_ALPHA)).otherwise(ba).alias("alpha"),
        F.when(few | no_err, F.lit(DEFAULT_BETA)).otherwise(bb).alias("beta"),
        (~few).alias("ok"))


# --------------------------------------------------------------------------
# metrics (NULL forecasts are skipped and counted)
# --------------------------------------------------------------------------
def metric_columns(y: Column, yhat: Column) -> list[Column]:
    from cantora.functions.scalar import r6
    ok = yhat.isNotNull() & y.isNotNull()
    ape = F.when(ok & (y > 0), F.abs((y - yhat) / y) * 100.0)
    den = F.abs(y) + F.abs(yhat)
    sape = F.when(ok & (den > 0), 2.0 * F.abs(y - yhat) / den * 100.0)
    abs_err = F.when(ok, F.abs(y - yhat))
    sum_abs_y = F.sum(F.when(ok, F.abs(y)))
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~ok).alias("null_forecasts"),
        r6(F.avg(ape)).alias("mape"),
        r6(F.avg(sape)).alias("smape"),
        r6(F.when(sum_abs_y != 0, F.sum(abs_err) / sum_abs_y * 100.0)).alias("wape"),
    ]
