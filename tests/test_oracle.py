"""Every registered query against its SQL at the smallest scale (verification.compare runs the larger ones)."""

import pytest

from verification.compare import compare, oracle_connection
from verification.oracle import ORACLE
from verification.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, connection, name):
    assert compare(spark, connection, FOLDER, name) == ""
