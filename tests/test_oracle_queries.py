"""Every query of the warehouse equals its DuckDB oracle (driver contract, small scale).

The training-data queries have tests of their own in ``tests/llm``.
"""

import pytest

from cardwatch import catalog
from oracle import compare, duck_connection

from conftest import SF_SMALL

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    ok, msg = compare(spark, name, SF_SMALL, QUERIES, ORACLE, duck)
    assert ok, msg
