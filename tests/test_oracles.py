"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    assert difference(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) == ""


def test_entry_has_rows_and_schema(spark):
    out = entry(spark)
    assert out.columns == ["start", "count", "sum", "avg", "points"]
    assert not out.isEmpty()
