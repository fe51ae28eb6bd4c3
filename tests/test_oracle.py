"""Every registered query against its DuckDB twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect

SF = os.environ.get("ADFLOW_TEST_SF", "/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    if name in ORACLES:
        assert compare(df, duck, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())
