"""Daily and hourly aggregates of readings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.bands import band
from gustline.functions.signals import signal_value
from gustline.schemas import POWER_KEY, SIGNAL_KEYS


def daily_distinct(readings: DataFrame, day: Column, name: str) -> DataFrame:
    """Distinct reading times per day.

    Spark plans it as de-duplication on (day, time) before the count per day, both with map-side
    partials, so a day or a time that holds most rows does not load one task.
    """
    return readings.groupBy(day).agg(F.count_distinct("signal_ts").alias(name))


def daily_distinct_derived(readings: DataFrame) -> DataFrame:
    """Day taken from the reading time; ordered by day."""
    day = F.to_date("signal_ts").alias("date")
    return daily_distinct(readings, day, "distinct_datapoints").orderBy("date")


def daily_distinct_stored(readings: DataFrame) -> DataFrame:
    """Day as stored with the reading."""
    return daily_distinct(readings, F.col("signal_date"), "distinct_signal_count")


def hourly_averages(readings: DataFrame, day: Column, values: Mapping[str, Column]) -> DataFrame:
    """Average of each value per day and hour: one shuffle of map-side partials.

    NULLs do not count; an hour of NULLs only averages to NULL. Directions are averaged as plain
    numbers, not on the circle.
    """
    return readings.groupBy(day, F.hour("signal_ts").alias("hour")).agg(
        *(F.avg(value).alias(name) for name, value in values.items())
    )


def hourly_from_map(readings: DataFrame, keys: Sequence[str] = SIGNAL_KEYS) -> DataFrame:
    """Hourly averages of map-valued signals, as 32-bit floats, named ``avg_<key>``."""
    return hourly_averages(readings, F.col("signal_date"), {f"avg_{key}": signal_value(key) for key in keys})


def hourly_from_columns(readings: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Hourly averages of typed columns (column -> result name), by derived day, in time order."""
    day = F.to_date("signal_ts").alias("date")
    values = {result: F.col(f"`{column}`") for column, result in names.items()}
    return hourly_averages(readings, day, values).orderBy("date", "hour")


def with_band(df: DataFrame, power: Column, name: str = "generation_indicator", **kwargs) -> DataFrame:
    """Add the generation band of a power value."""
    return df.withColumn(name, band(power, **kwargs))


def hourly_with_band(readings: DataFrame, keys: Sequence[str] = SIGNAL_KEYS) -> DataFrame:
    """Hourly averages of map-valued signals and the band of the average power."""
    return with_band(hourly_from_map(readings, keys), F.col(f"avg_{POWER_KEY}"))
