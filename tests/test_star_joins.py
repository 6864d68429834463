"""Dimension joins: broadcast by size, salted beyond it, NULL keys past the join; ad-hoc SQL."""
import pytest

from cantora.operators.star import dim_join, hot_keys, size_of
from cantora.plans.scans import register_views, run_sql


@pytest.fixture
def tables(spark, tmp_path):
    fact = spark.createDataFrame([(i, 7 if i % 3 else (None if i % 2 else i), f"v{i % 5}") for i in range(3000)], "id int, k int, v string")
    dim = spark.createDataFrame([(k, f"name{k}") for k in range(0, 3000, 4)] + [(7, "hot")], "k int, name string")
    dim.write.parquet(f"{tmp_path}/dim")     # a stored table has a known size
    return fact, spark.read.parquet(f"{tmp_path}/dim")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_the_plain_one(tables, how):
    fact, dim = tables
    want = sorted(map(str, fact.join(dim, "k", how).select("id", "k", "v", *(["name"] if how != "left_semi" else [])).collect()))
    for limit in (1 << 30, 0):
        got = dim_join(fact, dim, "k", how, limit=limit)
        assert sorted(map(str, got.select("id", "k", "v", *(["name"] if how != "left_semi" else [])).collect())) == want


def test_hot_keys_are_dealt_over_salts_and_small_dimensions_sent(tables):
    fact, dim = tables
    assert hot_keys(fact, "k") == [7] and size_of(dim) > 0
    plan = dim_join(fact, dim, "k", "inner", limit=0)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" not in plan or "_salt" in plan
    assert "Exchange hashpartitioning" not in dim_join(fact, dim, "k", "left")._jdf.queryExecution().executedPlan().toString()


def test_run_sql_binds_parameters_and_caps_rows(star_small):
    n = run_sql(star_small, "SELECT count(*) AS n FROM fct_sales WHERE units >= :u", {"u": 10}).first().n
    assert n == star_small.fct_sales.where("units >= 10").count()
    assert run_sql(star_small, "SELECT * FROM stg_rebates", max_rows=7).count() == 7
    assert run_sql(star_small, "SELECT p.brand, sum(s.units) AS u FROM fct_sales s JOIN dim_product p USING (product_id) GROUP BY ALL").count() == 25
    assert run_sql(star_small, "SELECT :x AS x", {"x": "1; DROP TABLE t"}).first().x == "1; DROP TABLE t"
    assert {"fct_sales", "mart_brand_perf", "stg_sales", "sales_raw"} <= set(register_views(star_small, []))
