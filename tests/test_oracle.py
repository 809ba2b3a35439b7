"""Every registered query against its DuckDB oracle on the smallest generated tables
(the driver runs the same comparison at sf0.01)."""

import pytest

from callsight.plans.registry import ORACLE, QUERIES
from paths import SF_SMALL
from oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, ns, nd, _, detail = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert ok, detail
    assert ns > 0
