"""Features and train/test splits."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.signals import quoted
from gustline.functions.split import MODULUS, split_position, split_rank
from gustline.operators.selection import smallest
from gustline.schemas import FEATURES, STATUS, STATUS_INDEX

# Share of training rows and seed.
TRAIN_SHARE = 0.8
SEED = 42


def fit_index(df: DataFrame, column: str = STATUS, output: str = STATUS_INDEX) -> StringIndexerModel:
    """Index of a category by falling frequency (ties by name); an unseen category is an error.

    The model holds one entry per category, which suits the handful of generation bands.
    """
    return StringIndexer(inputCol=column, outputCol=output).fit(df)


def assembler(
    features: Sequence[str] = FEATURES, output: str = "features", handle_invalid: str = "error"
) -> VectorAssembler:
    """Feature columns as one vector. A NULL feature is an error unless ``handle_invalid`` says
    ``skip`` (drop the row) or ``keep`` (NaN)."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid=handle_invalid)


def random_split(df: DataFrame, share: float = TRAIN_SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Random split. The same seed gives the same rows only for the same input partitioning, so give
    it a stored table rather than the result of a shuffle."""
    train, test = df.randomSplit([share, 1 - share], seed=seed)
    return train, test


def keyed_split(
    df: DataFrame, key: Column, share: float = TRAIN_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Split by a row's own integer key: two filters, no shuffle and no state, and the same answer on
    every run. A row with a NULL key is a training row."""
    chosen = F.coalesce(split_position(key, seed) < F.lit(share), F.lit(True))
    return df.filter(chosen), df.filter(~chosen)


def exact_split(
    df: DataFrame, key: Column, test_share: float = 1 - TRAIN_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(training, test) with exactly ceil(share * rows) test rows: those with the least places by their
    key, whatever the partitioning.

    The place that parts them is found by counting (see ``selection``); nothing is sorted and each side
    is a filter. Rows with one key at that place are told apart by a hash of the whole row, and copies
    of one row by their number alone, so such a key may hold any share of the rows. Rows without a key
    come last. Columns must be comparable (no maps). Give it a stored table: it is read a few times.
    """
    # the product of a binary share may lie a hair beyond a whole number
    wanted = math.ceil(round(df.count() * test_share, 6))
    rank = F.coalesce(split_rank(key, seed), F.lit(MODULUS).cast("bigint"))
    if not wanted:
        return df, df.limit(0)
    at, below = smallest(df, rank, [wanted])[wanted]
    tied = df.where(rank == at)
    first, rest = df.where(rank < at), df.where(rank > at)
    left = wanted - below
    if tied.count() == left:
        return rest, df.where(rank <= at)
    mark = F.xxhash64(*(F.col(quoted(name)) for name in df.columns))
    at2, below2 = smallest(tied, mark, [left])[left]
    first, rest = first.unionByName(tied.where(mark < at2)), rest.unionByName(tied.where(mark > at2))
    copies = tied.where(mark == at2).groupBy(*(F.col(quoted(name)) for name in df.columns)).agg(F.count(F.lit(1)).alias(_COPIES))
    taken = F.least(F.col(_COPIES), F.lit(left - below2))

    def times(number: Column) -> DataFrame:
        every = copies.where(number > 0).withColumn(_COPIES, F.explode(F.sequence(F.lit(1), number)))
        return every.select(*(F.col(quoted(name)) for name in df.columns))

    return rest.unionByName(times(F.col(_COPIES) - taken)), first.unionByName(times(taken))


_COPIES = "copies of one row"
