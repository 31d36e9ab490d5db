"""Every registered query against its SQL twin, whole tables."""

import os

import pytest

from tests.compare import connect, difference
from workload import oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = queries()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, con, name, QUERIES[name], SQL[name], SF_DIR) is None


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["id_frente", "nome_frente", "herfindahl_index", "diversidade"]
    assert 0 < df.count() <= 20
