"""Every registered query against its SQL, bit for bit."""

import pytest

import __spark_entry__ as entry_points
from oracle import compare, connect
from paytide.plans.oracle import ORACLE
from paytide.plans.queries import REGISTRY

SF = "/root/testdata/sf0.01"
NO_SQL = {"kpi_latency_approx", "column_profile_approx", "serving_json"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql_or_a_reason():
    assert set(REGISTRY) == set(ORACLE) | NO_SQL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    result = entry_points.queries()[name](spark, SF)
    assert compare(result, con, entry_points.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).columns == [
        "business_category", "transactions", "total_revenue", "avg_ticket_size"
    ]
