"""Time-series building blocks: lags, rolling frames, spines, year-over-year.

All windows here are partitioned by a series key (brand, product, brand x
canton) and run on aggregates whose series length is bounded by the number of
periods. Windows without a partition (grand totals, global ranks) are only
applied to frames of at most brands x months rows.

NULL ordering is spelled out (``asc_nulls_last``/``desc_nulls_first`` are the
reference database's defaults) so results do not depend on engine defaults.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantora.functions.scalar import safe_div


def w_series(part: list[str], order: str | Column) -> Window:
    o = F.col(order) if isinstance(order, str) else order
    return Window.partitionBy(*part).orderBy(o.asc_nulls_last())


def lag_change(df: DataFrame, value: str, part: list[str], order: str,
               prefix: str = "") -> DataFrame:
    """Previous value, absolute change and percent change (NULL when the
    previous value is NULL or 0)."""
    w = w_series(part, order)
    lag = F.lag(value).over(w)
    cur = F.col(value)
    return df.withColumns({
        f"{prefix}lag": lag,
        f"{prefix}abs_chg": cur - lag,
        f"{prefix}pct_chg": F.when(lag.isNull() | (lag == 0), F.lit(None).cast("double"))
        .otherwise(cur.cast("double") / lag.cast("double") - 1.0),
    })


def rolling(df: DataFrame, value: str, part: list[str], order: str, lo: int, hi: int,
            fn=F.sum, name: str | None = None) -> DataFrame:
    w = w_series(part, order).rowsBetween(lo, hi)
    return df.withColumn(name or f"{fn.__name__}_{value}", fn(value).over(w))


def running_total(df: DataFrame, value: str, part: list[str], order: str,
                  name: str) -> DataFrame:
    """SUM OVER (PARTITION .. ORDER BY ..) with the default RANGE frame:
    peers (equal order values) share the running value."""
    w = w_series(part, order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(w))


def prev_mean(df: DataFrame, value: str, part: list[str], order: str, k: int,
              name: str) -> DataFrame:
    """Mean of the previous ``k`` rows (at least one), NULL for the first row:
    pandas ``shift(1).rolling(k, min_periods=1).mean()``."""
    w = w_series(part, order).rowsBetween(-k, -1)
    return df.withColumn(name, F.avg(F.col(value).cast("double")).over(w))


def month_spine(bounds: DataFrame, lo: str = "lo", hi: str = "hi",
                name: str = "month_start") -> DataFrame:
    """Month starts from ``lo`` to ``hi`` of a one-row frame, generated on the
    executors (``explode(sequence(..))``)."""
    return bounds.select(F.explode(F.sequence(F.trunc(lo, "month"), F.trunc(hi, "month"),
                                              F.expr("INTERVAL 1 MONTH"))).alias(name))


def densify(df: DataFrame, group: str, date_col: str, values: list[str]) -> DataFrame:
    """Gap-fill a monthly series per group over the global month range; missing
    measures become 0. The spine is built per group by exploding a month
    sequence (one-row bounds broadcast to the group keys), not by a cross join
    of two relations."""
    bounds = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    groups = df.select(group).distinct()
    spine = groups.crossJoin(F.broadcast(bounds)).select(
        group, F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias(date_col))
    j = spine.join(df, [group, date_col], "left")
    return j.select(group, date_col, *[F.coalesce(F.col(v), F.lit(0)).alias(v) for v in values])


def yoy(df: DataFrame, keys: list[str], date_col: str, value: str,
        ly_name: str = "ly") -> DataFrame:
    """Same month last year of a frame with one row per key and month: a RANGE
    frame of exactly 12 months back, so a gap stays NULL and the frame is read
    once. A row without a date has no last year."""
    month = F.year(date_col) * 12 + F.month(date_col)
    w = Window.partitionBy(*keys).orderBy(month).rangeBetween(-12, -12)
    return df.withColumn(ly_name, F.when(F.col(date_col).isNotNull(), F.max(value).over(w)))


def with_last_year(df: DataFrame, keys: list[str], date_col: str, value: str,
                   ly_name: str = "ly") -> DataFrame:
    """The rows of ``df`` that have a row a year earlier, with its value (which
    may be NULL: the value is carried in a struct)."""
    j = yoy(df.withColumn("_v", F.struct(F.col(value).alias("x"))), keys, date_col, "_v", "_ly")
    return j.where(F.col("_ly").isNotNull()).withColumn(ly_name, F.col("_ly")["x"]).drop("_v", "_ly")


def share_of_total(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    """value / Σ value over the whole frame; the total is a one-row aggregate
    broadcast to every row (its size is proven: one row)."""
    tot = df.agg(F.sum(value).alias("_tot"))
    return df.crossJoin(F.broadcast(tot)).withColumn(name, safe_div(F.col(value), F.col("_tot"))) \
        .drop("_tot")
