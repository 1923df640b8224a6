"""Every query against its SQL on the smallest tables."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_entry_gives_rows(spark):
    assert entry(spark).count() == 4


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, connection, name):
    assert difference(spark, connection, name, SF_DIR) is None
