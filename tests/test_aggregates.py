"""Aggregates, bands and renaming on hand-made rows."""

import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gustline.functions.bands import band
from gustline.operators.aggregates import (
    daily_distinct_derived,
    daily_distinct_stored,
    hourly_from_columns,
    hourly_from_map,
    hourly_with_band,
    with_band,
)
from gustline.operators.readings import promote_signals
from gustline.operators.renaming import long_form, map_names, one_pair_per_name, rename_columns
from gustline.plans.flows import hourly_status
from gustline.schemas import HOURLY_MAPPING, HOURLY_SCHEMA, ROW_MAPPING, SIGNAL_KEYS, TYPED_AVERAGES
from gustline.sources.tables import mapping_relation, mapping_view

IDS = ["signal_date", "hour"]


def reading(time, power, speed="5", **more):
    signals = {"ActivePower_kW": power, "WindSpeed_m_s": speed, "PowerCurve_kWh": "7", "WindDirection_deg": "10"} | more
    stamp = dt.datetime.fromisoformat(time)
    return stamp.date(), stamp, signals


ROWS = [
    reading("2018-01-01T00:00:00", "100"),
    reading("2018-01-01T00:10:00", "300"),
    reading("2018-01-01T00:20:00", "not a number"),
    reading("2018-01-01T00:30:00", None),
    reading("2018-01-01T02:00:00", "1000", WindDirection_deg="350"),
    reading("2018-01-01T02:50:00", "1000", WindDirection_deg="10"),
    reading("2018-01-01T23:50:00", "599.999"),
    reading("2018-01-02T00:00:00", None),
]


@pytest.fixture
def readings(spark):
    return spark.createDataFrame(ROWS, "signal_date date, signal_ts timestamp, signals map<string,string>")


def by_hour(df):
    return {(row.signal_date.day, row.hour): row for row in df.collect()}


def test_hourly_averages(readings):
    rows = by_hour(hourly_from_map(readings))
    assert set(rows) == {(1, 0), (1, 2), (1, 23), (2, 0)}
    assert rows[1, 0].avg_ActivePower_kW == 200.0  # text and NULL do not count
    assert rows[2, 0].avg_ActivePower_kW is None  # nothing but NULL
    assert rows[1, 2].avg_WindDirection_deg == 180.0  # plain average, not on the circle
    assert rows[1, 23].avg_ActivePower_kW == pytest.approx(599.9990234375, abs=0)  # 32-bit value


def test_bands_of_hours(readings):
    rows = by_hour(hourly_with_band(readings))
    assert {key: row.generation_indicator for key, row in rows.items()} == {
        (1, 0): "Medium",
        (1, 2): "Exceptional",
        (1, 23): "Medium",
        (2, 0): "Exceptional",
    }


def test_copies_of_readings_change_nothing(readings):
    four = readings.unionAll(readings).unionAll(readings).unionAll(readings)
    for operator in (hourly_with_band, daily_distinct_stored, daily_distinct_derived):
        assert sorted(operator(four).collect()) == sorted(operator(readings).collect())
    typed = promote_signals(four, {"power": "ActivePower_kW"}, "double")
    once = promote_signals(readings, {"power": "ActivePower_kW"}, "double")
    assert hourly_from_columns(typed, {"power": "p"}).collect() == hourly_from_columns(once, {"power": "p"}).collect()


def test_hot_groups_equal_brute_force(spark):
    """A third of all rows are copies of one reading, another third falls on one day."""
    chance = random.Random(5)
    hot = reading("2018-01-02T05:00:00", "123.456")
    rows = [hot] * 400
    rows += [reading(f"2018-01-03T{chance.randrange(24):02d}:{chance.randrange(60):02d}:00", str(i / 7)) for i in range(400)]
    rows += [
        reading(f"2018-01-{chance.randrange(1, 29):02d}T{chance.randrange(24):02d}:{chance.randrange(60):02d}:00", str(i * 3.1))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "signal_date date, signal_ts timestamp, signals map<string,string>").repartition(8)
    times, powers = defaultdict(set), defaultdict(list)
    for day, time, signals in rows:
        times[day].add(time)
        powers[day.day, time.hour].append(float(np.float32(signals["ActivePower_kW"])))
    found = {row.signal_date: row.distinct_signal_count for row in daily_distinct_stored(df).collect()}
    assert found == {day: len(of_day) for day, of_day in times.items()}
    averages = by_hour(hourly_from_map(df))
    assert set(averages) == set(powers)
    for key, of_hour in powers.items():
        assert averages[key].avg_ActivePower_kW == pytest.approx(sum(of_hour) / len(of_hour), rel=1e-12)


def test_daily_distinct(readings):
    more = readings.unionAll(readings.limit(3))
    assert [tuple(row) for row in daily_distinct_derived(more).collect()] == [
        (dt.date(2018, 1, 1), 7),
        (dt.date(2018, 1, 2), 1),
    ]
    stored = daily_distinct_stored(more)
    assert stored.columns == ["signal_date", "distinct_signal_count"]
    assert {row.signal_date.day: row.distinct_signal_count for row in stored.collect()} == {1: 7, 2: 1}


def test_stored_day_without_time_counts_nothing(spark):
    rows = [(dt.date(2018, 1, 1), None), (dt.date(2018, 1, 1), dt.datetime(2018, 1, 1, 1))]
    df = spark.createDataFrame(rows, "signal_date date, signal_ts timestamp")
    assert daily_distinct_stored(df).first().distinct_signal_count == 1


def test_typed_averages_are_in_time_order(readings):
    names = {name: key for name, key in zip(TYPED_AVERAGES, SIGNAL_KEYS, strict=True)}
    result = hourly_from_columns(promote_signals(readings, names, "double"), TYPED_AVERAGES)
    rows = result.collect()
    assert result.columns == ["date", "hour", *TYPED_AVERAGES.values()]
    assert [(row.date.day, row.hour) for row in rows] == [(1, 0), (1, 2), (1, 23), (2, 0)]
    assert rows[2].avg_active_power == 599.999


@pytest.mark.parametrize(
    ("power", "label"),
    [
        (None, "Exceptional"),
        (-5.0, "Low"),
        (199.999, "Low"),
        (200.0, "Medium"),
        (599.999, "Medium"),
        (600.0, "High"),
        (999.999, "High"),
        (1000.0, "Exceptional"),
        (float("nan"), "Exceptional"),
    ],
)
def test_band_edges(spark, power, label):
    df = spark.createDataFrame([(power,)], "p double")
    row = df.select(band(F.col("p")).alias("plain"), band(F.col("p"), null_label="Unknown").alias("named")).first()
    assert row.plain == label
    assert row.named == ("Unknown" if power is None else label)


def test_own_bands(spark):
    df = spark.createDataFrame([(1.0,), (5.0,)], "p double")
    own = with_band(df, F.col("p"), "size", bands=[(2.0, "small")], rest="large")
    assert [row["size"] for row in own.collect()] == ["small", "large"]
    with pytest.raises(ValueError):
        band(F.col("p"), [(2.0, "a"), (1.0, "b")])


def test_absent_keys_give_null_and_the_rest_band(readings):
    names = {name: name for name in TYPED_AVERAGES}
    found = hourly_from_columns(promote_signals(readings, names), TYPED_AVERAGES)
    for row in with_band(found, F.col("avg_active_power")).collect():
        assert list(row)[2:] == [None] * 4 + ["Exceptional"]


def test_rename_by_mapping(spark, readings):
    mapping = mapping_relation(spark, [("hour", "h"), ("missing", "x"), ("hour", "second"), ("signal_date", None)])
    renamed = rename_columns(hourly_from_map(readings), mapping)
    assert renamed.columns[:2] == ["signal_date", "h"]
    assert "x" not in renamed.columns


def test_rename_handles_special_characters(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "`LV ActivePower (kW)` double, `Wind Direction (°)` double")
    renamed = rename_columns(df, mapping_relation(spark, ROW_MAPPING))
    assert renamed.columns == ["active_power_average", "wind_direction_average"]


def test_mapping_view_has_bag_semantics(spark):
    pairs = [("a", "x"), ("a", "x"), ("it's", "y")]
    view = mapping_view(spark, pairs, "test_mapping")
    assert [tuple(row) for row in view.collect()] == pairs
    assert spark.table("test_mapping").columns == ["sig_name", "sig_mapping_name"]


def test_hourly_table_schema(readings):
    assert hourly_status(readings).dtypes == [(f.name, f.dataType.simpleString()) for f in HOURLY_SCHEMA]


def test_names_as_data_equal_names_as_schema(spark, readings):
    averages = hourly_from_map(readings)
    mapping = mapping_relation(spark, HOURLY_MAPPING)
    joined = map_names(long_form(averages, IDS), mapping, IDS, averages.columns)
    renamed = long_form(rename_columns(averages, mapping), IDS)
    assert sorted(map(str, joined.collect())) == sorted(
        map(str, renamed.withColumnRenamed("sig_name", "sig_mapping_name").collect())
    )


def test_unknown_names_stay(spark, readings):
    averages = hourly_from_map(readings)
    joined = map_names(long_form(averages, IDS), mapping_relation(spark, HOURLY_MAPPING[:1]), IDS, averages.columns)
    names = {row.sig_mapping_name for row in joined.collect()}
    assert names == {"active_power_average", *(f"avg_{key}" for key in SIGNAL_KEYS[1:])}


def test_contradicting_pairs_follow_one_rule(spark, readings):
    averages = hourly_from_map(readings)
    extra = spark.range(100_000).selectExpr("'hour' as sig_name", "concat('z', id) as sig_mapping_name")
    mapping = mapping_relation(spark, [*HOURLY_MAPPING, ("hour", "a")]).unionByName(extra)
    for parts in (1, 7):
        spread = mapping.repartition(parts)
        assert one_pair_per_name(spread, averages.columns).count() == len(HOURLY_MAPPING[:4]) + 1
        assert "a" in rename_columns(averages, spread).columns
    long = long_form(averages.withColumn("power", F.lit(1.0)), IDS)
    many = mapping_relation(spark, [("power", "p2"), ("power", "p1"), ("power", None)])
    joined = map_names(long, many, IDS, ["power"])
    assert joined.count() == long.count()
    assert joined.filter("sig_mapping_name = 'p1'").count() == averages.count()
