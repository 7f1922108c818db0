"""Every registered query against its SQL on the smallest tables."""

import oracle_compare
import pytest

import __spark_entry__ as entry_point
from orderloom.plans.oracles import ORACLES
from orderloom.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_compare.connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert oracle_compare.compare(spark, con, SF, name, QUERIES[name], ORACLES[name]) == ""


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["year_month", "revenue", "orders", "unique_customers"]
    assert df.count() > 0
