"""Every query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import difference, duck
from tidemark.queries import all_queries, all_sql

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_id", "user_id", "ts", "amount", "last_view", "last_click"]


def test_every_query_of_the_library_has_sql():
    assert set(all_sql()) == set(all_queries())
    assert set(all_queries()) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_query_equals_sql(spark, con, name):
    assert difference(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) is None
