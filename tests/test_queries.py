"""Every registered query against its SQL twin."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point
from gustline.plans.catalog import QUERIES
from gustline.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, folder, connection):
    assert differences(QUERIES[name](spark, folder), ORACLES[name], connection) == []


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark, folder):
    result = entry_point.entry(spark)
    assert result.columns == [
        "signal_date",
        "hour",
        "active_power_average",
        "wind_speed_average",
        "theo_power_curve_average",
        "wind_direction_average",
        "generation_status",
    ]
    assert result.count() > 0
    assert set(entry_point.queries()) >= set(entry_point.oracle_sql())
