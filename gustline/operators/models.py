"""Regression models on the hourly table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.operators.features import SEED, assembler, fit_index
from gustline.schemas import FEATURES, LABEL, STATUS_INDEX

# Default size of a tree, and the deepest tree MLlib grows.
TREE_DEPTH = 5
TREE_BINS = 32
DEEPEST = 30


def linear(features: str = "features", label: str = LABEL, prediction: str = "prediction") -> LinearRegression:
    """Least squares with intercept and without regularisation. With a few features the fit is one
    pass over the rows (a sum of small matrices) and a solve of their size on the driver."""
    return LinearRegression(featuresCol=features, labelCol=label, predictionCol=prediction)


def tree(
    features: str = "features",
    label: str = LABEL,
    prediction: str = "prediction",
    max_depth: int = TREE_DEPTH,
    max_bins: int = TREE_BINS,
    seed: int = SEED,
) -> DecisionTreeRegressor:
    """Decision tree. ``max_depth=DEEPEST`` comes closest to a tree without a depth limit; split
    points are still taken from ``max_bins`` quantiles of a feature."""
    return DecisionTreeRegressor(
        featuresCol=features,
        labelCol=label,
        predictionCol=prediction,
        maxDepth=max_depth,
        maxBins=max_bins,
        seed=seed,
    )


def fit_flow(
    table: DataFrame,
    train: DataFrame,
    regressor: Estimator,
    features: Sequence[str] = FEATURES,
    handle_invalid: str = "error",
) -> PipelineModel:
    """Index, assemble and fit as one saveable model.

    The index is fitted on the whole ``table``, the regressor on ``train`` only. The default features
    contain the index of a band that is computed from the label itself; leave ``STATUS_INDEX`` out of
    ``features`` for a model without that leak.
    """
    stages: list[Transformer | Estimator] = []
    if STATUS_INDEX in features:
        stages.append(fit_index(table))
    stages += [assembler(features, regressor.getFeaturesCol(), handle_invalid), regressor]
    return Pipeline(stages=stages).fit(train)


def score_day(model: Transformer, table: DataFrame, day: dt.date, label: str = LABEL) -> DataFrame:
    """Score the rows of one day; the day filter reaches the scan (and prunes day partitions)."""
    rows = table.filter(F.col("signal_date") == F.lit(day))
    return model.transform(rows).select("signal_date", "hour", label, "prediction")


def side_by_side(
    rows: DataFrame, models: dict[str, Transformer], keep: Sequence[str], label: str = LABEL
) -> DataFrame:
    """Score the same rows with several models: (keep, model, actual, prediction), one row per model.

    Each model works on the columns of the previous one's output, so the rows are read once.
    """
    scored = rows
    columns = []
    for number, (name, model) in enumerate(models.items()):
        column = f"prediction_{number}"
        before = set(scored.columns)
        scored = model.transform(scored).withColumnRenamed("prediction", column)
        scored = scored.drop(*(set(scored.columns) - before - {column}))
        columns.append(F.struct(F.lit(name).alias("model"), F.col(column).alias("prediction")))
    pairs = scored.select(*keep, F.col(label).alias("actual"), F.explode(F.array(*columns)).alias("pair"))
    return pairs.select(*keep, "pair.model", "actual", "pair.prediction")
