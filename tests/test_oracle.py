"""Every registered query against its DuckDB statement on sf0.001."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "Product Category" and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF)
    assert res["status"] in ("ok", "rows-only"), res
