"""Banding of a power value into generation classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gustline.schemas import BAND_REST, BANDS


def band(
    power: Column,
    bands: Sequence[tuple[float, str]] = BANDS,
    rest: str = BAND_REST,
    null_label: str | None = None,
) -> Column:
    """Label of the first band whose upper bound lies above ``power``, else ``rest``.

    A NULL power matches no band and so gets ``rest``; give ``null_label`` to tell it apart.
    """
    bounds = [upper for upper, _ in bands]
    if bounds != sorted(set(bounds)):
        raise ValueError("band bounds must ascend")
    arms = [(power < F.lit(upper), label) for upper, label in bands]
    if null_label is not None:
        arms.insert(0, (power.isNull(), null_label))
    (condition, label), *others = arms
    chain = F.when(condition, label)
    for condition, label in others:
        chain = chain.when(condition, label)
    return chain.otherwise(rest)
