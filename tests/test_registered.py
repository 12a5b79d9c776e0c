"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_points
import registered

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_check():
    assert set(registered.ORACLES) == set(registered.QUERIES)


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query_equals_sql(spark, con, name):
    df = registered.QUERIES[name](spark, SF)
    assert differences(con, df, registered.ORACLES[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["dedup_readings", "interval_times", "batch_select", "batch_window"])
def test_results_do_not_depend_on_the_session_zone(spark, con, any_zone, name):
    df = registered.QUERIES[name](spark, SF)
    assert differences(con, df, registered.ORACLES[name]) is None
