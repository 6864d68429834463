"""Guarded scalar math.

Spark's ``greatest/least`` skip NULL, while the reference's pandas ``clip`` and
``np.maximum`` propagate a missing value. These helpers keep NULL in, NULL out.
Ratios divide doubles and return NULL on a zero denominator (ANSI mode would
raise)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(x: Column, lower: Column, upper: Column) -> Column:
    """pandas ``Series.clip(lower, upper)`` with NULL propagation."""
    return F.when(x.isNotNull() & lower.isNotNull() & upper.isNotNull(),
                  F.least(F.greatest(x, lower), upper))


def max0(x: Column) -> Column:
    """``np.maximum(0, x)`` with NULL propagation."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), x))


def safe_div(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)`` on doubles."""
    return F.try_divide(num.cast("double"), F.nullif(den.cast("double"), F.lit(0.0)))


def ratio6(num: Column, den: Column) -> Column:
    """Double ratio rounded to 6 places (the cross-engine comparison grain)."""
    return F.round(safe_div(num, den), 6)


def dbl(x: Column) -> Column:
    return x.cast("double")


def money(x: Column, precision: int = 18) -> Column:
    """Exact decimal sum/amount as a double. The decimal value is exact, the
    conversion is correctly rounded, so every engine agrees on it."""
    return x.cast("double")


def r6(x: Column) -> Column:
    """Round half up to 6 places with IEEE operations only:
    ``floor(x * 1e6 + 0.5) / 1e6``. Used on double aggregates whose summation
    order is not fixed (avg, stddev, sums of ratios): the same double gives the
    same bits in every engine, unlike decimal-based ``round`` whose tie rule
    differs between engines."""
    return F.when(x.isNotNull(), F.floor(x.cast("double") * 1e6 + 0.5).cast("double") / 1e6)


def cents(x: Column, precision: int = 12) -> Column:
    """Double -> DECIMAL(p,2) through integer cents, ``floor(x*100 + 0.5)``.
    A direct cast rounds differently per engine (shortest decimal string vs
    exact binary value); this form is bit-identical everywhere."""
    return (F.floor(x * 100.0 + 0.5).cast(f"decimal({precision},0)")
            * F.lit("0.01").cast("decimal(3,2)")).cast(f"decimal({precision},2)")
