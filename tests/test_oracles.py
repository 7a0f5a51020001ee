"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from cobble.plans.queries import QUERIES
from harness import compare, duck

SF = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in ORACLES, "every registered query has an oracle"
    ok, msg = compare(E.queries()[name](spark, SF), con, ORACLES[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["pid", "y2015", "y2016", "y2017", "y2018", "y2019", "slope", "copy"]
