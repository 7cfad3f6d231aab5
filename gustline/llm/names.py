"""Column names: new ones, and frames whose own do not matter."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores behind it as long as a column is called so (case does not count)."""
    known = {column.lower() for column in taken}
    while name.lower() in known:
        name += "_"
    return name


def numbered(df: DataFrame) -> DataFrame:
    """The frame with columns c0, c1, ..., for functions over batches, which do not take every name."""
    return df.toDF(*(f"c{k}" for k in range(len(df.columns))))
