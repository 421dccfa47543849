"""Every registered query against its SQL. COMANDA_SF_DIR selects another table folder."""

import os

import pytest

from checks.compare import difference, duck
from checks.oracles import oracle_texts
from checks.registry import QUERIES, run

FOLDER = os.environ.get("COMANDA_SF_DIR", "/root/testdata/sf0.001")
ORACLES = oracle_texts()


@pytest.fixture(scope="module")
def connection():
    with duck(FOLDER) as open_connection:
        yield open_connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_same_result(spark, connection, name):
    assert difference(run(name, spark, FOLDER), connection, ORACLES[name]) is None
