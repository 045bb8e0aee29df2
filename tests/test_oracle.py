"""Every registered query against its SQL."""

import pytest
from compare import compare, connect

import registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("key", QUERIES)
def test_query_equals_sql(spark, con, key):
    _, differences = compare(spark, con, QUERIES[key], ORACLE[key], SF_DIR)
    assert not differences, "\n".join(differences)
