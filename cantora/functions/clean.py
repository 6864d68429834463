"""Cleaning functions for raw TEXT cells (Column -> Column).

Each is one built-in expression tree (no UDF, no subquery), so it stays inside
whole-stage codegen. They reproduce the reference's cleaning macros exactly,
quirks included:

* ``clean_text``  nulls only ``NULL`` (any case, any surrounding whitespace) and
  blanks; ``N/A`` stays. Trim strips spaces only.
* ``clean_int``   strips *every* non-digit, so ``-5`` -> 5 and ``12.00`` -> 1200.
  Out-of-range integers give NULL (the database would raise).
* ``clean_numeric`` tries the EU form before the US form, so ``1,234`` ->
  1.234; ``1.234.567`` -> NULL; ASCII apostrophe is not stripped.
* ``clean_date``  ISO with ``-`` or ``/``, ``DD.MM.YYYY``, and ``xx/yy/YYYY``
  read as DD/MM when the first part is > 12, else MM/DD. Impossible dates give
  NULL (the database would raise); ``YYYY-MM-DD 00:00:00`` gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from the reference's cleaning rules.
NULL_LIKES = ["", "NULL", "N/A", "NA"]
# Characters removed before parsing a number: space, U+2019, U+2032, U+2033, U+00B4.
NUMBER_NOISE = " ’′″´"
UNICODE_MINUS = "−"
EU_GROUPED = r"^[-+]?\d{1,3}(\.\d{3})+,\d+$"
COMMA_DECIMAL = r"^[-+]?\d+,\d+$"
US_GROUPED_DECIMAL = r"^[-+]?\d{1,3}(,\d{3})+\.\d+$"
US_GROUPED_INT = r"^[-+]?\d{1,3}(,\d{3})+$"
DOT_DECIMAL = r"^[-+]?\d+\.\d+$"
PLAIN_INT = r"^[-+]?\d+$"
# The same forms by what is done to them: one pattern each.
PLAIN = r"^[-+]?\d+(?:\.\d+)?$"
EU = r"^[-+]?(?:\d{1,3}(?:\.\d{3})+|\d+),\d+$"
US = r"^[-+]?\d{1,3}(?:,\d{3})+(?:\.\d+)?$"
ISO_DATE = r"^\d{4}[-/]\d{2}[-/]\d{2}$"
DOTTED_DATE = r"^\d{2}\.\d{2}\.\d{4}$"
SLASH_DATE = r"^\d{2}/\d{2}/\d{4}$"

NUMERIC_TYPE = "decimal(38,10)"


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _trim_spaces(s: Column) -> Column:
    # Spark's trim strips the space character only, like TRIM(BOTH FROM ...).
    return F.trim(s)


def _null_like(s: Column) -> Column:
    return F.upper(_trim_spaces(s)).isin(*NULL_LIKES)


def clean_text(c: Column | str) -> Column:
    s = _s(c)
    return F.nullif(_trim_spaces(F.regexp_replace(s, r"(?i)^\s*NULL\s*$", "")), F.lit(""))


def clean_int(c: Column | str) -> Column:
    s = _s(c)
    digits = F.nullif(F.regexp_replace(s, "[^0-9]", ""), F.lit(""))
    return F.when(s.isNull() | _null_like(s), F.lit(None).cast("int")) \
        .otherwise(digits.try_cast("int"))


def clean_numeric(c: Column | str) -> Column:
    # no branch takes a null-like text: each needs digits and nothing but number characters. The plain form has no
    # comma and the other two need one, so it is asked for first; EU goes before US.
    s1 = F.translate(F.replace(_trim_spaces(_s(c)), F.lit(UNICODE_MINUS), F.lit("-")), NUMBER_NOISE, "")
    text = (F.when(s1.rlike(PLAIN), s1)
            .when(s1.rlike(EU), F.translate(s1, ",.", "."))
            .when(s1.rlike(US), F.translate(s1, ",", "")))
    return text.try_cast(NUMERIC_TYPE)


def clean_date(c: Column | str) -> Column:
    s = _s(c)
    t = _trim_spaces(s)
    first = F.split_part(t, F.lit("/"), F.lit(1)).try_cast("int")
    return (
        F.when(s.isNull() | _null_like(s), F.lit(None).cast("date"))
        .when(t.rlike(ISO_DATE), F.try_to_date(F.replace(t, F.lit("/"), F.lit("-")),
                                               "yyyy-MM-dd"))
        .when(t.rlike(DOTTED_DATE), F.try_to_date(t, "dd.MM.yyyy"))
        .when(t.rlike(SLASH_DATE),
              F.when(first > 12, F.try_to_date(t, "dd/MM/yyyy"))
              .otherwise(F.try_to_date(t, "MM/dd/yyyy")))
    )
