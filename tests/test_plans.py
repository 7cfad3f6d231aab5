"""Physical plans of the queries that matter at scale."""

import re

import pytest
from plans import physical, simple

from gustline.plans.catalog import QUERIES

BATCH = [
    "hourly_status",
    "daily_distinct_derived",
    "daily_distinct_stored",
    "hourly_averages_typed",
    "hourly_averages_map",
    "band_rows",
    "mapping_union",
    "mapping_inline",
    "rename_columns",
    "mapping_broadcast_join",
    "day_filter",
    "top_hours",
    "preview_rows",
    "payload_roundtrip",
    "parse_readings",
    "invalid_rows",
    "keyed_split_events",
]


def shuffles(plan):
    return len(re.findall(r"\bExchange (?:hash|range|Single|Round)", plan))


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(name, spark, folder):
    plan = simple(QUERIES[name](spark, folder))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("hourly_status", 1),
        ("hourly_averages_map", 1),
        ("mapping_broadcast_join", 2),  # the averages, and the mapping cut to one pair per name
        ("day_filter", 1),
        ("daily_distinct_stored", 2),
        ("band_rows", 0),
        ("mapping_inline", 0),
        ("parse_readings", 0),
        ("payload_roundtrip", 0),
        ("invalid_rows", 1),
        ("keyed_split_events", 1),
    ],
)
def test_number_of_shuffles(name, expected, spark, folder):
    assert shuffles(simple(QUERIES[name](spark, folder))) == expected


def test_aggregates_combine_before_the_shuffle(spark, folder):
    assert "partial_avg" in simple(QUERIES["hourly_status"](spark, folder))
    assert "partial_count" in simple(QUERIES["daily_distinct_stored"](spark, folder))


def test_day_filter_reaches_the_scan(spark, folder):
    plan = physical(QUERIES["day_filter"](spark, folder))
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(ts,2024-01-19.*LessThan\(ts,2024-01-20", plan)


def test_scan_reads_needed_columns_only(spark, folder):
    assert "ReadSchema: struct<ts:timestamp_ntz>" in physical(QUERIES["daily_distinct_stored"](spark, folder))
    assert "ReadSchema: struct<event_id:bigint>" in physical(QUERIES["keyed_split_events"](spark, folder))


def test_mapping_is_broadcast(spark, folder):
    plan = simple(QUERIES["mapping_broadcast_join"](spark, folder))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


@pytest.mark.parametrize("name", ["top_hours", "preview_rows"])
def test_first_rows_are_a_top_k(name, spark, folder):
    plan = simple(QUERIES[name](spark, folder))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


def test_promoted_columns_prune_the_map(spark, folder):
    scan = physical(QUERIES["stream_to_hourly"](spark, folder))
    assert "signals" not in re.search(r"ReadSchema: (.*)", scan).group(1)
