"""Every registered query beside its SQL twin."""

import pytest

import __spark_entry__ as entry
from checks.compare import difference

QUERIES, SQL = entry.queries(), entry.oracle_sql()
SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    assert difference(spark, name, QUERIES[name], SQL.get(name), SF_DIR) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
