"""Every SQL-expressible query equals its DuckDB oracle (row count, column
names, value kinds, order-insensitive values) on the test tables."""

import pytest

from conftest import TEST_SF
from quarry.plans.catalog import load_all
from quarry.plans.check import compare

REG = load_all()
SQL_QUERIES = sorted(n for n, q in REG.items() if q.sql)


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_query_matches_oracle(spark, duck, name):
    r = compare(spark, duck, REG[name], TEST_SF)
    assert r["status"] == "OK", r


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 200
