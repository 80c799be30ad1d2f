"""Every registered query against its DuckDB formulation on the sf0.001 tables."""

import os

import pytest

import __spark_entry__ as E
from crosscheck import compare, duck_connection

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    sql = E.oracle_sql().get(name)
    r = compare(spark, con, name, E.queries()[name], sql, SF)
    if sql is None:
        assert r["spark_rows"] > 0
    else:
        assert r["match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["src", "key", "redacted_text", "n_redacted"]
