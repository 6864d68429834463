"""The joined sales lines."""
from pyspark.sql import functions as F

from cantora.sources.bridge import Star
from cantora.sources.store import _file_months
from cantora.sources.tables import Tables

SMALL = "/root/testdata/sf0.001"


def test_lines_carry_no_long_text_through_the_joins(spark):
    """Brand and priority are cut to their digits before the joins, once a part and order."""
    lines = Star(Tables(spark, SMALL)).sales_lines
    above = lines._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)[0]
    assert "regexp_extract" not in above and "substring" not in above


def test_file_months_with_and_without_dates(spark, tmp_path):
    rows = [(1, "2024-01-31"), (2, "2024-01-01"), (3, "2024-03-05"), (4, None), (5, None)]
    spark.createDataFrame(rows, "id int, d string").withColumn("d", F.to_timestamp_ntz("d")).coalesce(1).write.parquet(str(tmp_path / "t"))
    got = _file_months(spark.read.parquet(str(tmp_path / "t")), "d").collect()
    assert [r.months for r in got] == [["2024-01-01", "2024-03-01", "none"]]
