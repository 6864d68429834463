"""Golden cells of the four cleaning functions."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cantora.functions.clean import clean_date, clean_int, clean_numeric, clean_text

D = dt.date
# input, clean_text, clean_int, clean_numeric, clean_date
CELLS = [
    ("NULL", None, None, None, None),
    (" null ", None, None, None, None),
    ("N/A", "N/A", None, None, None),
    ("", None, None, None, None),
    ("-5", "-5", 5, Decimal("-5"), None),
    ("12.00", "12.00", 1200, Decimal("12.00"), None),
    ("1,234", "1,234", 1234, Decimal("1.234"), None),
    ("1,234.56", "1,234.56", 123456, Decimal("1234.56"), None),
    ("1.234,56", "1.234,56", 123456, Decimal("1234.56"), None),
    ("1234,56", "1234,56", 123456, Decimal("1234.56"), None),
    ("1,234,567", "1,234,567", 1234567, Decimal("1234567"), None),
    ("1.234.567", "1.234.567", 1234567, None, None),
    ("1’234.50", "1’234.50", 123450, Decimal("1234.50"), None),
    ("−7.5", "−7.5", 75, Decimal("-7.5"), None),
    ("abc", "abc", None, None, None),
    ("2024-06-23", "2024-06-23", 20240623, None, D(2024, 6, 23)),
    ("2024/06/23", "2024/06/23", 20240623, None, D(2024, 6, 23)),
    ("23.06.2024", "23.06.2024", 23062024, None, D(2024, 6, 23)),
    ("06/13/2024", "06/13/2024", 6132024, None, D(2024, 6, 13)),
    ("13/06/2024", "13/06/2024", 13062024, None, D(2024, 6, 13)),
    ("05/06/2024", "05/06/2024", 5062024, None, D(2024, 5, 6)),
    ("2024-06-23 00:00:00", "2024-06-23 00:00:00", None, None, None),
    ("31/02/2024", "31/02/2024", 31022024, None, None),
    (None, None, None, None, None),
]


def test_golden_cells(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CELLS)], "i int, c string")
    out = df.select("i", clean_text("c").alias("t"), clean_int("c").alias("n"),
                    clean_numeric("c").alias("x"), clean_date("c").alias("d")).orderBy("i").collect()
    for row, (cell, t, n, x, d) in zip(out, CELLS):
        assert row.t == t, cell
        assert row.n == n, cell
        assert (row.x is None and x is None) or (row.x is not None and x is not None and row.x == x), cell
        assert row.d == d, cell


def test_clean_is_builtin_only(spark):
    """No Python UDF in the plan: the expressions stay JVM-side."""
    df = spark.createDataFrame([("1,234.56",)], "c string")
    plan = df.select(clean_numeric("c"), clean_date("c"))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_clean_numeric_asks_for_three_forms(spark):
    """One pattern for each thing that is done to a cell."""
    df = spark.createDataFrame([("1,234.56",)], "c string")
    plan = df.select(clean_numeric("c").alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") <= 3
