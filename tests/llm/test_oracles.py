"""Every training-data query that SQL can express against its DuckDB SQL, on whole tables."""

import pytest

from faregrid.llm import queries
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, name, queries.QUERIES[name], queries.ORACLES[name], SF_SMALL)
