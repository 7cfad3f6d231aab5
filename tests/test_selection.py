"""Order statistics and splits of exact size against sorting."""

import math

import numpy as np
import pytest
from plans import simple
from pyspark.sql import functions as F

from gustline.functions.split import split_rank
from gustline.operators.features import exact_split
from gustline.operators.selection import double_of, double_order, quantiles, smallest

ODD = [0.0, -0.0, 1e-300, -1e-300, 5e-324, 1e300, -1e300, 1.0, 1.0000000000000002, -1.0, 1.7976931348623157e308]


def test_doubles_keep_their_order(spark):
    numbers = [*ODD, *np.random.default_rng(1).normal(size=200).tolist()]
    rows = spark.createDataFrame([(x,) for x in numbers], "x double").select("x", double_order(F.col("x")).alias("k")).collect()
    by_key = [row.x for row in sorted(rows, key=lambda row: row.k)]
    assert by_key == sorted(numbers)
    assert all(double_of(row.k) == row.x for row in rows)
    assert len({row.k for row in rows if row.x == 0}) == 1


@pytest.mark.parametrize("seed", range(5))
def test_smallest_equals_sorting(spark, seed):
    random = np.random.default_rng(seed)
    limit = [10, 5000, 1 << 40, 1 << 63, 1][seed]
    numbers = random.integers(-limit, limit, 700).tolist() + [3] * 400 + [-(1 << 63)] * (seed == 3) + [(1 << 63) - 1] * (seed == 3)
    df = spark.createDataFrame([(x,) for x in [*numbers, None]], "v long").repartition(3)
    ordered = sorted(numbers)
    ranks = [1, 2, 17, len(ordered) // 2, len(ordered) // 2 + 1, len(ordered)]
    found = smallest(df, F.col("v"), [*ranks, 0, len(ordered) + 1])
    assert found == {r: (ordered[r - 1], sum(x < ordered[r - 1] for x in ordered)) for r in ranks}
    assert smallest(df.limit(0), F.col("v"), [1]) == {}


def test_quantiles_equal_numpy(spark):
    for numbers in (ODD, [2.0], [1.0, 2.0], np.random.default_rng(3).exponential(size=1001).tolist()):
        df = spark.createDataFrame([(x,) for x in [*numbers, None, math.nan, math.inf]], "x double")
        assert quantiles(df, "x", (0.25, 0.5, 0.75)) == pytest.approx(list(np.percentile(numbers, [25, 50, 75])), rel=1e-12)
    assert quantiles(df.limit(0), "x", (0.5,)) == []


@pytest.mark.parametrize("share", [0.2, 0.25, 0.0, 1.0, 0.501])
def test_split_has_its_exact_size(spark, share):
    df = spark.range(0, 1003, numPartitions=3).select(F.col("id").alias("k"))
    train, test = exact_split(df, F.col("k"), share)
    chosen = {row.k for row in test.collect()}
    assert len(chosen) == math.ceil(round(1003 * share, 6)) and chosen | {row.k for row in train.collect()} == set(range(1003))
    assert len(chosen) + train.count() == 1003
    again = exact_split(df.repartition(7, "k"), F.col("k"), share)[1]
    assert {row.k for row in again.collect()} == chosen
    ranks = sorted((row.r, row.k) for row in df.select("k", split_rank(F.col("k")).alias("r")).collect())
    assert chosen == {k for _, k in ranks[: len(chosen)]}


def test_split_of_repeated_keys_and_rows(spark):
    rows = [(7, "same")] * 300 + [(7, f"row {k}") for k in range(200)] + [(None, "no key")] * 50 + [(k, "x") for k in range(100, 150)]
    df = spark.createDataFrame(rows, "`a key` long, text string").repartition(4)
    for share in (0.2, 0.5, 0.9, 0.97):
        train, test = exact_split(df, F.col("`a key`"), share)
        parts = train.collect(), test.collect()
        assert len(parts[1]) == math.ceil(round(600 * share, 6))
        assert sorted(map(str, parts[0] + parts[1])) == sorted(map(str, df.collect()))
        again = exact_split(df.repartition(2), F.col("`a key`"), share)[1]
        assert sorted(map(str, again.collect())) == sorted(map(str, parts[1]))
    assert exact_split(df.limit(0), F.col("`a key`"))[1].count() == 0


def test_nothing_is_sorted(spark):
    train, test = exact_split(spark.range(1000).select(F.col("id").alias("k")), F.col("k"))
    assert "Sort" not in simple(train) and "Exchange" not in simple(test)
