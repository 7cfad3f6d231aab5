"""Features, splits, models and their evaluation."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gustline.functions.split import hour_key, split_position
from gustline.operators.evaluation import (
    Spread,
    density,
    histogram,
    joint_counts,
    metrics,
    not_finite,
    spread,
    with_residual,
)
from gustline.operators.features import assembler, fit_index, keyed_split, random_split
from gustline.operators.models import DEEPEST, fit_flow, linear, score_day, side_by_side, tree
from gustline.plans.flows import train
from gustline.schemas import FEATURES, HOURLY_SCHEMA, LABEL, STATUS, STATUS_INDEX

PLAIN = [name for name in FEATURES if name != STATUS_INDEX]


@pytest.fixture(scope="module")
def hourly(spark, tmp_path_factory):
    """Ten days of hours; power follows speed and the theoretical curve, with noise."""
    chance = random.Random(7)
    rows = []
    for day in range(10):
        for hour in range(24):
            speed, curve = chance.uniform(0, 20), chance.uniform(0, 3000)
            power = 30 * speed + 0.2 * curve + chance.gauss(0, 20)
            status = "Low" if power < 200 else "Medium" if power < 600 else "High" if power < 1000 else "Exceptional"
            rows.append((dt.date(2018, 1, day + 10), hour, power, speed, curve, chance.uniform(0, 360), status))
    path = str(tmp_path_factory.mktemp("hourly") / "table")
    spark.createDataFrame(rows, HOURLY_SCHEMA).write.parquet(path)
    return spark.read.schema(HOURLY_SCHEMA).parquet(path)


def statuses(spark, *names):
    return spark.createDataFrame([(name,) for name in names], f"{STATUS} string")


def test_index_by_frequency_then_name(spark):
    df = statuses(spark, "Low", "High", "High", "Medium", "Exceptional", "Low")
    assert fit_index(df).labels == ["High", "Low", "Exceptional", "Medium"]


def test_unseen_status_is_an_error(spark):
    model = fit_index(statuses(spark, "Low"))
    with pytest.raises(Exception, match="(?i)unseen"):
        model.transform(statuses(spark, "High")).collect()


def test_null_feature(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    with pytest.raises(Exception, match="(?i)null"):
        assembler(["a", "b"]).transform(df).collect()
    assert assembler(["a", "b"], handle_invalid="skip").transform(df).count() == 1
    kept = assembler(["a", "b"], handle_invalid="keep").transform(df).select(vector_to_array("features").alias("v"))
    assert sorted(math.isnan(row.v[0]) for row in kept.collect()) == [False, True]


def keys(df):
    return {(row.signal_date, row.hour) for row in df.select("signal_date", "hour").collect()}


@pytest.mark.parametrize("split", [random_split, lambda df: keyed_split(df, hour_key())])
def test_splits_partition_the_rows(hourly, split):
    train_rows, test_rows = split(hourly)
    assert keys(train_rows) | keys(test_rows) == keys(hourly)
    assert not keys(train_rows) & keys(test_rows)
    assert 0.7 < train_rows.count() / hourly.count() < 0.9


def test_keyed_split_does_not_depend_on_layout(hourly):
    _, once = keyed_split(hourly, hour_key())
    _, again = keyed_split(hourly.repartition(7).orderBy(F.rand()), hour_key())
    assert keys(once) == keys(again)


def test_split_positions(spark):
    source = spark.range(-500, 9500).unionAll(spark.range(2**62, 2**62 + 10))
    positions = source.select(split_position(F.col("id")).alias("p"))
    row = positions.agg(F.min("p"), F.max("p"), F.avg((F.col("p") < 0.8).cast("int"))).first()
    assert 0 <= row[0] and row[1] < 1
    assert row[2] == pytest.approx(0.8, abs=0.005)
    other = source.filter((split_position(F.col("id"), 1) < 0.8) != (split_position(F.col("id"), 42) < 0.8))
    assert other.count() > 0


def test_row_without_key_is_kept(spark):
    df = spark.createDataFrame([(None,), (1,)], "k bigint")
    parts = keyed_split(df, F.col("k"))
    assert sum(part.count() for part in parts) == 2


def test_line_equals_least_squares(hourly):
    flow = fit_flow(hourly, hourly, linear(), PLAIN)
    rows = hourly.select(*PLAIN, LABEL).toPandas()
    design = np.column_stack([rows[PLAIN].to_numpy(), np.ones(len(rows))])
    exact, *_ = np.linalg.lstsq(design, rows[LABEL].to_numpy(), rcond=None)
    line = flow.stages[-1]
    assert list(line.coefficients) + [line.intercept] == pytest.approx(list(exact), rel=1e-6)
    residuals = with_residual(flow.transform(hourly), LABEL)
    assert residuals.agg(F.avg("residual")).first()[0] == pytest.approx(0, abs=1e-6)


def test_index_is_fitted_on_the_whole_table(hourly):
    one_status = hourly.filter(f"{STATUS} = 'Low'")
    flow = fit_flow(hourly, one_status, linear())
    assert len(flow.stages[0].labels) == 4
    assert flow.transform(hourly).count() == hourly.count()


def test_flow_can_be_saved(hourly, tmp_path):
    from pyspark.ml import PipelineModel

    flow = fit_flow(hourly, hourly, linear())
    flow.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    order = ["signal_date", "hour"]
    left, right = (m.transform(hourly).orderBy(order).select("prediction").collect() for m in (flow, again))
    assert left == right


def test_deepest_tree_repeats_its_training_rows(spark):
    rows = [(float(i), float(i * i)) for i in range(30)]
    df = spark.createDataFrame(rows, f"x double, {LABEL} double")
    flow = fit_flow(df, df, tree(max_depth=DEEPEST), ["x"])
    assert metrics(flow.transform(df), LABEL).first().mse == pytest.approx(0, abs=1e-9)
    shallow = fit_flow(df, df, tree(max_depth=2), ["x"])
    assert metrics(shallow.transform(df), LABEL).first().mse > 1


def test_score_day(hourly):
    flow = fit_flow(hourly, hourly, linear())
    day = score_day(flow, hourly, dt.date(2018, 1, 19))
    assert day.columns == ["signal_date", "hour", LABEL, "prediction"]
    assert day.count() == 24
    assert score_day(flow, hourly, dt.date(2017, 1, 1)).count() == 0


def test_metrics_equal_the_evaluator(hourly):
    scored = fit_flow(hourly, hourly, linear()).transform(hourly)
    found = metrics(scored, LABEL).first()
    for name in ("mse", "rmse", "mae", "r2"):
        expected = RegressionEvaluator(labelCol=LABEL, metricName=name).evaluate(scored)
        assert found[name] == pytest.approx(expected, rel=1e-9)
    assert found.rmse**2 == pytest.approx(found.mse)
    assert found["rows"] == 240


def test_metrics_of_special_cases(spark):
    rows = [("perfect", 1.0, 1.0), ("perfect", 2.0, 2.0), ("constant", 5.0, 4.0), ("constant", 5.0, 6.0)]
    rows += [("missing", None, 1.0), ("missing", 1.0, None), ("missing", 3.0, 2.0)]
    df = spark.createDataFrame(rows, "model string, actual double, prediction double")
    found = {row.model: row for row in metrics(df, "actual", by=["model"]).collect()}
    assert (found["perfect"].mse, found["perfect"].r2) == (0.0, 1.0)
    assert (found["constant"].mae, found["constant"].r2) == (1.0, None)
    assert found["missing"]["rows"] == 1
    assert metrics(df.limit(0), "actual").first().mse is None


def test_side_by_side(hourly):
    train_rows, test_rows = keyed_split(hourly, hour_key())
    models = {
        "line": fit_flow(hourly, train_rows, linear()),
        "tree": fit_flow(hourly, train_rows, tree()),
    }
    both = side_by_side(test_rows, models, ["signal_date", "hour"])
    assert both.columns == ["signal_date", "hour", "model", "actual", "prediction"]
    for name, model in models.items():
        alone = model.transform(test_rows).select("signal_date", "hour", F.col(LABEL).alias("actual"), "prediction")
        mine = both.filter(F.col("model") == name).drop("model")
        assert sorted(mine.collect()) == sorted(alone.collect())


def values(spark, numbers):
    return spark.createDataFrame([(float(x),) for x in numbers], "x double")


def test_histogram_equals_numpy(spark):
    numbers = np.random.default_rng(1).normal(size=500)
    found = {row.bin: row for row in histogram(values(spark, numbers), "x", 12).collect()}
    counts, edges = np.histogram(numbers, 12)
    assert [found[i]["rows"] if i in found else 0 for i in range(12)] == list(counts)
    assert [found[i].low for i in found] == pytest.approx([edges[i] for i in found])
    assert [found[i].high for i in found] == pytest.approx([edges[i + 1] for i in found])


def test_histogram_takes_its_number_of_bins_from_the_data(spark):
    numbers = np.random.default_rng(2).normal(size=1000)
    rows = histogram(values(spark, numbers), "x").collect()
    width = rows[0].high - rows[0].low
    iqr = np.subtract(*np.percentile(numbers, [75, 25]))
    assert width == pytest.approx(min(2 * iqr / 10, np.ptp(numbers) / (math.log2(1000) + 1)), rel=0.1)
    assert sum(row["rows"] for row in rows) == 1000


def test_an_outlier_does_not_multiply_the_bins(spark):
    numbers = [*np.random.default_rng(4).uniform(size=1000), 1e12]
    rows = histogram(values(spark, numbers), "x").collect()
    assert sorted(row["rows"] for row in rows if row["rows"]) == [1, 1000]
    assert max(row.bin for row in rows) < 2 * math.sqrt(1001) + 1


def test_histogram_of_few_values(spark):
    assert [row["rows"] for row in histogram(values(spark, [3, 3, 3]), "x", 4).orderBy("bin").collect()] == [0, 0, 3, 0]
    assert [row["rows"] for row in histogram(values(spark, [3, 3, 3]), "x").collect()] == [3]
    assert histogram(values(spark, []), "x").count() == 0
    assert histogram(values(spark, []), "x", 5).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_automatic_bins_are_those_of_numpy(spark, seed):
    random = np.random.default_rng(seed)
    numbers = [random.normal(size=777), random.exponential(size=1000), random.integers(0, 9, 500) / 3, random.normal(size=6)][seed]
    rows = histogram(values(spark, numbers).repartition(3), "x").orderBy("bin").collect()
    counts, edges = np.histogram(numbers, "auto")
    assert [row["rows"] for row in rows] == list(counts)
    assert [row.low for row in rows] == pytest.approx(list(edges[:-1]))


def test_values_that_are_not_finite_are_left_out(spark):
    odd = [math.inf, -math.inf, math.nan, math.inf]
    numbers = [1.0, 2.0, 2.5, 4.0]
    mixed, plain = values(spark, numbers + odd), values(spark, numbers)
    for bins in (None, 4):
        assert sorted(histogram(mixed, "x", bins).collect()) == sorted(histogram(plain, "x", bins).collect())
    curves = [sorted(density(df, "x").collect()) for df in (mixed, plain)]
    assert [r.density for r in curves[0]] == pytest.approx([r.density for r in curves[1]])
    pairs = spark.createDataFrame([(1.0, 2.0), (math.inf, 1.0), (1.0, -math.inf), (3.0, 1.0), (math.nan, 1.0)], "actual double, prediction double")
    cells = joint_counts(pairs, "actual", bins=4)
    assert sorted(cells.collect()) == sorted(joint_counts(pairs.where("actual in (1, 3) and prediction > 0"), "actual", bins=4).collect())
    assert {row.line_end for row in cells.collect()} == {3.0}
    told = not_finite(spark.createDataFrame([(x, 1.0) for x in [*odd, None, 2.0]], "`it's` double, y double"), "it's", "y")
    assert sorted(map(tuple, told.collect())) == [("it's", 1, 1, 3), ("y", 0, 0, 0)]
    nothing = values(spark, odd)
    assert histogram(nothing, "x").count() == density(nothing, "x").count() == 0


def test_spread_ignores_null(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert spread(df, "x") == Spread(2, 1.0, 3.0, pytest.approx(math.sqrt(2)), None)


@pytest.mark.parametrize("cut", [0.0, 3.0])
def test_density_equals_the_exact_sum(spark, cut):
    numbers = np.random.default_rng(3).normal(10, 4, size=400)
    rows = sorted(density(values(spark, numbers), "x", cut=cut).collect())
    assert [row.point for row in rows] == list(range(200))
    width = numbers.std(ddof=1) * len(numbers) ** -0.2
    grid = np.linspace(numbers.min() - cut * width, numbers.max() + cut * width, 200)
    exact = np.exp(-0.5 * ((grid[:, None] - numbers) / width) ** 2).sum(axis=1) / (
        len(numbers) * width * math.sqrt(2 * math.pi)
    )
    assert [row.x for row in rows] == pytest.approx(list(grid))
    assert [row.density for row in rows] == pytest.approx(list(exact), rel=1e-4, abs=1e-9)


def test_density_without_spread_is_empty(spark):
    assert density(values(spark, [2, 2, 2]), "x").collect() == []
    assert density(values(spark, []), "x").collect() == []


def test_joint_counts(spark):
    df = spark.createDataFrame([(0.0, 0.0), (10.0, 5.0), (9.9, 4.9), (None, 1.0)], "actual double, prediction double")
    rows = {(row.actual_bin, row.prediction_bin): row for row in joint_counts(df, "actual", bins=10).collect()}
    assert {key: row["rows"] for key, row in rows.items()} == {(0, 0): 1, (9, 5): 1, (9, 4): 1}
    assert rows[9, 5].line_end == 10.0
    assert rows[9, 5].actual_low == pytest.approx(9.0)
    assert joint_counts(df.limit(0), "actual").count() == 0


def test_training(hourly):
    result = train(hourly, dt.date(2018, 1, 19))
    found = {row.model: row for row in result.metrics.collect()}
    assert set(found) == {"linear", "tree"}
    assert found["linear"].r2 > 0.9
    assert result.day.count() == 24
    for name in result.models:
        rows = result.histogram(name).agg(F.sum("rows")).first()[0]
        assert rows == found[name]["rows"] == result.joint_counts(name).agg(F.sum("rows")).first()[0]
        assert result.density(name).count() == 200
    assert len(result.line().coefficients) == len(FEATURES)
