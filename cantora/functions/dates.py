"""Date helpers (Column -> Column, built-ins only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(d: Column) -> Column:
    """Start of the calendar's week. The reference buckets days with pandas
    period ``W-MON`` (weeks that *end* on Monday), so weeks start on Tuesday:
    2025-08-11 (Mon) -> 2025-08-05, 2025-08-12 (Tue) -> 2025-08-12."""
    return F.date_sub(F.next_day(d, "TUE"), 7)


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def make_month(year: Column, month: Column) -> Column:
    """``make_date(year, month, 1)``."""
    return F.make_date(year, month, F.lit(1))


def period_label(year: Column, month: Column) -> Column:
    """``'YYYY-MM'`` label from year and month (zero-padded month)."""
    return F.format_string("%d-%02d", year, month)


def quarter_start(d: Column) -> Column:
    return F.trunc(d, "quarter")


def year_start(d: Column) -> Column:
    return F.trunc(d, "year")


def month_spine(lo: Column, hi: Column) -> Column:
    """Array of month starts from ``lo`` to ``hi`` inclusive (explode it)."""
    return F.sequence(month_start(lo), month_start(hi), F.expr("INTERVAL 1 MONTH"))
