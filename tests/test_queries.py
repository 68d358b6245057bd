"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, con, name):
    got = queries()[name](spark, SF).toPandas()
    assert len(got) > 0
    sql = oracle_sql().get(name)
    if sql is not None:
        assert compare(got, con.sql(sql).df()) is None


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["processed_date", "messages", "characters"]
