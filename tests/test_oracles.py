"""Every query of the trip engine against its DuckDB SQL on the smallest test tables.

The driver runs the same comparison at sf0.01; this keeps it in the test suite
at sf0.001 so a broken operator fails fast.
"""

import os

import pytest

import __spark_entry__ as E
from faregrid.plans.catalog import QUERIES
from faregrid.plans.oracles import ORACLES
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF_SMALL, verbose=True)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"pickup_date", "pickup_borough", "revenue", "rolling_7d_revenue"} <= set(df.columns)
