"""Queries of the subpackage that SQL can express, against DuckDB on the given tables."""
import pytest

from cantora.llm import queries
from scripts.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, key):
    df = queries.QUERIES[key](spark, SF)
    res = duck(SF).execute(queries.ORACLES[key])
    assert compare([tuple(r) for r in df.collect()], df.columns, res.fetchall(), [d[0] for d in res.description]) is None
