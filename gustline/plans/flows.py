"""Batch flows: analysis of the reading table, training and evaluation on the hourly table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.functions.signals import quoted
from gustline.functions.split import hour_key
from gustline.operators.aggregates import daily_distinct_stored, hourly_with_band, with_band
from gustline.operators.evaluation import density, histogram, joint_counts, metrics, with_residual
from gustline.operators.features import exact_split, keyed_split
from gustline.operators.models import fit_flow, linear, score_day, side_by_side, tree
from gustline.operators.readings import promote_signals, split_invalid
from gustline.operators.renaming import rename_columns
from gustline.schemas import (
    FEATURES,
    HOURLY_MAPPING,
    HOURLY_SCHEMA,
    LABEL,
    POWER_KEY,
    READING_SCHEMA,
    ROW_MAPPING,
    SIGNAL_OF_FIELD,
    STATUS,
    STATUS_INDEX,
)
from gustline.session import stage
from gustline.sources.tables import (
    check_apart,
    mapping_relation,
    mapping_view,
    read_table,
    replace_table,
)

MAPPING_VIEW = "signal_name_mapping"


def hourly_status(readings: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """The hourly table: averages of the signals and the band of the power, under mapped names."""
    if mapping is None:
        mapping = mapping_view(readings.sparkSession, HOURLY_MAPPING, MAPPING_VIEW)
    return rename_columns(hourly_with_band(readings), mapping)


def typed_readings(readings: DataFrame, *extra: str) -> DataFrame:
    """Readings with their signals as double columns under the raw field names instead of the map."""
    promoted = promote_signals(readings, SIGNAL_OF_FIELD, "double")
    return promoted.select(*extra, "signal_ts", *(F.col(quoted(name)) for name in SIGNAL_OF_FIELD))


def banded_rows(typed: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Typed readings with the band of each row's power, under mapped names."""
    if mapping is None:
        mapping = mapping_relation(typed.sparkSession, ROW_MAPPING)
    power = next(name for name, key in SIGNAL_OF_FIELD.items() if key == POWER_KEY)
    return rename_columns(with_band(typed, F.col(quoted(power))), mapping)


def analyse(
    spark: SparkSession,
    readings_path: str,
    hourly_path: str,
    daily_path: str,
    format: str = "parquet",
    only_valid: bool = False,
) -> None:
    """Daily counts and the hourly table, each computed once and written as a full replacement.

    With ``only_valid`` readings without a time, such as those of malformed messages, are left out.
    """
    check_apart(readings_path, hourly_path, daily_path)
    readings = read_table(spark, readings_path, format, READING_SCHEMA if format != "delta" else None)
    if only_valid:
        readings, _ = split_invalid(readings)
    replace_table(daily_distinct_stored(readings), daily_path, format)
    replace_table(hourly_status(readings), hourly_path, format)


@dataclass(frozen=True)
class Training:
    """Models by name and the frames that describe them on the test rows."""

    models: dict[str, PipelineModel]
    scored: DataFrame
    metrics: DataFrame
    day: DataFrame
    left_out: int = 0

    def histogram(self, model: str, bins: int | None = None) -> DataFrame:
        return histogram(self.residuals(model), "residual", bins)

    def density(self, model: str) -> DataFrame:
        return density(self.residuals(model), "residual")

    def joint_counts(self, model: str) -> DataFrame:
        return joint_counts(self._of(model), "actual")

    def residuals(self, model: str) -> DataFrame:
        return with_residual(self._of(model), "actual")

    def _of(self, model: str) -> DataFrame:
        return self.scored.filter(self.scored["model"] == model)

    def line(self) -> LinearRegressionModel:
        return self.models["linear"].stages[-1]


def usable(hourly: DataFrame) -> DataFrame:
    """Hourly rows with a day, an hour, a label, a status and all features."""
    needed = ["signal_date", "hour", LABEL, STATUS, *(name for name in FEATURES if name != STATUS_INDEX)]
    for name in dict.fromkeys(needed):
        hourly = hourly.filter(F.col(name).isNotNull())
    return hourly


def train(hourly: DataFrame, day: dt.date, handle_invalid: str = "error", exact: bool = False) -> Training:
    """Fit a linear model and a tree on the training rows of the hourly table, score the test rows
    with both, and score one day with the linear model.

    A row with a missing value, such as the hour of malformed messages, is an error, or with
    ``handle_invalid="skip"`` left out of everything; ``left_out`` tells how many were. With ``exact`` the
    test rows are exactly a fifth, rounded up; else each row's own key decides, and about a fifth are.
    """
    left_out = 0
    if handle_invalid == "skip":
        kept = usable(hourly)
        left_out = hourly.count() - kept.count()
        hourly = kept
    split = exact_split if exact else keyed_split
    training, test = split(hourly, hour_key())
    models = {
        "linear": fit_flow(hourly, training, linear()),
        "tree": fit_flow(hourly, training, tree()),
    }
    scored = stage(side_by_side(test, models, ["signal_date", "hour"]), "scored")
    return Training(
        models=models,
        scored=scored,
        metrics=metrics(scored, "actual", by=["model"]),
        day=score_day(models["linear"], hourly, day, LABEL),
        left_out=left_out,
    )


def train_from_table(
    spark: SparkSession,
    hourly_path: str,
    day: dt.date,
    format: str = "parquet",
    handle_invalid: str = "error",
    exact: bool = False,
) -> Training:
    schema = HOURLY_SCHEMA if format != "delta" else None
    return train(read_table(spark, hourly_path, format, schema), day, handle_invalid, exact)
