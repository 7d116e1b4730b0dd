"""Every registered query against its DuckDB oracle at sf0.001 (the driver's check)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from changeflow.plans.registry import QUERIES as OWN
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
        return
    res = compare(df, con, sql)
    assert res["cols_match"], res
    assert res["rows_spark"] == res["rows_oracle"], res
    assert res["values_match"], res


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["tracking_id", "dt", "status", "current_location"]


def test_every_query_has_oracle_or_is_listed():
    assert {q for q in set(queries()) - set(oracle_sql()) if q in OWN} == set()
