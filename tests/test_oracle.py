"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SF = os.environ.get("ZONELENS_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF)
    assert r["status"] in ("ok", "no-oracle"), r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["asn", "n_rows"]
