"""Readings derived from the given ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.functions.signals import signal_map
from gustline.schemas import SIGNAL_OF_FIELD, TIME_FIELD

# The instrument values of an event, by raw field name.
_POWER_FACTOR = 12
_SPEED_STEPS = 25
_CURVE_FACTOR = 36
_DEGREES = 360


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def _instrument_values() -> dict[str, Column]:
    steps = F.get_json_object("props", "$.k").try_cast("bigint")
    columns = (
        F.col("value") * _POWER_FACTOR,
        F.col("user_id") % _SPEED_STEPS,
        steps * _CURVE_FACTOR,
        F.col("event_id") % _DEGREES,
    )
    return dict(zip(SIGNAL_OF_FIELD, columns, strict=True))


def readings_from_events(events: DataFrame, *extra: str) -> DataFrame:
    """Readings with the signal map, at the full resolution of ``ts`` (zone-free)."""
    by_key = {SIGNAL_OF_FIELD[name]: value for name, value in _instrument_values().items()}
    return events.select(
        *extra,
        F.to_date("ts").alias("signal_date"),
        F.col("ts").alias("signal_ts"),
        signal_map(by_key).alias("signals"),
    )


def rows_from_events(events: DataFrame, *extra: str) -> DataFrame:
    """Raw rows as a logger would write them: minute text and four doubles."""
    return events.select(
        *extra,
        F.date_format("ts", "dd MM yyyy HH:mm").alias(TIME_FIELD),
        *(value.cast("double").alias(name) for name, value in _instrument_values().items()),
    )
