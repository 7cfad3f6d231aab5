"""Messages, times and the signal map on hand-made rows."""

import datetime as dt

import pytest
from plans import simple
from pyspark.sql import Row
from pyspark.sql import functions as F

from gustline.functions.signals import reading_date, reading_time, signal_value
from gustline.operators.readings import (
    parse_messages,
    parse_readings,
    promote_signals,
    raw_text,
    split_invalid,
    to_payload,
    with_validity,
)
from gustline.schemas import CSV_SCHEMA, MESSAGE_SCHEMA, READING_SCHEMA, SIGNAL_KEYS

WHOLE = (
    '{"Date/Time":"01 02 2018 00:10","LV ActivePower (kW)":380.047790527343,"Wind Speed (m/s)":1.0E-4,'
    '"Theoretical_Power_Curve (KWh)":416.3,"Wind Direction (°)":259.9}'
)


def messages(spark, *bodies):
    return spark.createDataFrame([(i, body) for i, body in enumerate(bodies)], "id int, value string")


def test_rows_to_json_leave_out_nulls(spark):
    rows = spark.createDataFrame([("01 01 2018 00:00", 1.5, None, 2.0, None)], CSV_SCHEMA)
    [row] = to_payload(rows).collect()
    assert row.value == (
        '{"Date/Time":"01 01 2018 00:00","LV ActivePower (kW)":1.5,"Theoretical_Power_Curve (KWh)":2.0}'
    )


def test_parse_keeps_number_text_and_month_order(spark):
    [row] = parse_readings(messages(spark, WHOLE)).collect()
    assert row.signal_date == dt.date(2018, 2, 1)
    assert row.signal_ts == dt.datetime(2018, 2, 1, 0, 10)
    assert set(row.signals) == set(SIGNAL_KEYS)
    assert row.signals["ActivePower_kW"] == "380.047790527343"
    assert row.signals["WindSpeed_m_s"] == "1.0E-4"


def test_result_schema(spark):
    found = parse_readings(messages(spark, WHOLE)).schema
    assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in READING_SCHEMA]


def test_malformed_messages_stay_and_blanks_go(spark):
    bodies = ["{broken", "null", "[]", "7", '{"other":1}', "", "  ", "\t\n", None, WHOLE]
    rows = {row.id: row for row in parse_readings(messages(spark, *bodies), "id").collect()}
    assert set(rows) == {0, 1, 2, 3, 4, 9}
    for broken in (0, 1, 2, 3, 4):
        assert rows[broken].signal_ts is None
        assert rows[broken].signal_date is None
        assert rows[broken].signals == dict.fromkeys(SIGNAL_KEYS)


@pytest.mark.parametrize(
    "body", ["{broken", "null", "[]", "7", "", "  ", "\t", "\n \r", "\x0b", "\f", '""', "{}", WHOLE, None]
)
def test_blank_filter_equals_filter_on_the_parsed_struct(spark, body):
    source = messages(spark, body)
    by_struct = source.select(F.from_json("value", MESSAGE_SCHEMA).alias("data")).filter("data is not null")
    assert parse_messages(source).collect() == by_struct.collect()


def test_missing_fields_are_null(spark):
    [row] = parse_readings(messages(spark, '{"Date/Time":"31 12 2018 23:50"}')).collect()
    assert row.signal_ts == dt.datetime(2018, 12, 31, 23, 50)
    assert row.signals == dict.fromkeys(SIGNAL_KEYS)


@pytest.mark.parametrize(
    ("text", "date", "time"),
    [
        ("01 02 2018 00:00", dt.date(2018, 2, 1), dt.datetime(2018, 2, 1)),
        ("1 2 2018 7:05", dt.date(2018, 2, 1), dt.datetime(2018, 2, 1, 7, 5)),
        ("01 02 2018 23:50:30", dt.date(2018, 2, 1), dt.datetime(2018, 2, 1, 23, 50)),
        ("01 02 2018 00:00 abc", dt.date(2018, 2, 1), dt.datetime(2018, 2, 1)),
        ("01 02 2018 00:00abc", dt.date(2018, 2, 1), dt.datetime(2018, 2, 1)),
        ("01 02 2018 00:00 PM", dt.date(2018, 2, 1), dt.datetime(2018, 2, 1)),
        ("01 02 2018 25:00", dt.date(2018, 2, 1), None),
        ("01 02 2018", dt.date(2018, 2, 1), None),
        ("29 02 2020 12:00", dt.date(2020, 2, 29), dt.datetime(2020, 2, 29, 12)),
        ("29 02 2019 12:00", None, None),
        ("01 13 2018 00:00", None, None),
        ("2018-01-01 00:00", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_times(spark, text, date, time):
    row = spark.createDataFrame([(text,)], "t string").select(
        reading_date(F.col("t")).alias("date"), reading_time(F.col("t")).alias("time")
    )
    assert row.first() == Row(date=date, time=time)


def test_session_zone_decides_the_instant(spark, zone):
    source = messages(spark, WHOLE)

    def seconds():
        return parse_readings(source).select(F.unix_timestamp("signal_ts").alias("s"), "signal_date").first()

    utc = seconds()
    zone("Asia/Kolkata")
    india = seconds()
    assert utc.s - india.s == int(5.5 * 3600)
    assert utc.signal_date == india.signal_date


def test_ingestion_time_is_one_per_batch(spark):
    stamped = parse_readings(messages(spark, *[WHOLE] * 50).repartition(4))
    assert stamped.select("create_ts").distinct().count() == 1
    assert stamped.filter("create_date = to_date(create_ts)").count() == 50


def test_bytes_are_text(spark):
    source = messages(spark, WHOLE).withColumn("value", F.col("value").cast("binary"))
    assert raw_text(source).first().raw_data == WHOLE
    assert parse_readings(source).first().signals["WindDirection_deg"] == "259.9"


def test_split_is_a_partition(spark):
    readings = parse_readings(messages(spark, WHOLE, "{broken", "null", WHOLE, ""))
    valid, invalid = split_invalid(readings)
    assert (valid.count(), invalid.count()) == (2, 2)
    flags = with_validity(readings).groupBy("is_valid").count().collect()
    assert {row.is_valid: row["count"] for row in flags} == {True: 2, False: 2}


def test_signal_values(spark):
    source = spark.sql("SELECT map('a', '380.047790527343', 'b', 'n/a', 'c', CAST(NULL AS STRING)) AS signals")
    row = source.select(
        *(signal_value(key).cast("double").alias(key) for key in "abcd"),
        signal_value("a", "double").alias("wide"),
    ).first()
    assert row == Row(a=380.04779052734375, b=None, c=None, d=None, wide=380.047790527343)


def test_promoted_columns_stand_beside_the_map(spark):
    readings = promote_signals(parse_readings(messages(spark, WHOLE)), {"speed": "WindSpeed_m_s", "none": "absent"})
    assert readings.dtypes[-2:] == [("speed", "float"), ("none", "float")]
    row = readings.first()
    assert row.speed == pytest.approx(1e-4)
    assert row.none is None
    assert "WindSpeed_m_s" in row.signals


def test_parser_runs_once_per_message(spark, tmp_path):
    path = str(tmp_path / "topic")
    messages(spark, WHOLE).select("value").write.text(path)
    plan = simple(parse_readings(spark.read.text(path)))
    assert plan.count("from_json(") == 1
    assert "Exchange" not in plan
    assert "Python" not in plan
