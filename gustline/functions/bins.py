"""Fixed-width binning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_bin(value: Column, low: float, width: float, bins: int) -> Column:
    """Bin number 0 .. bins-1; the last bin is closed on the right, like a histogram's."""
    raw = F.floor((value - F.lit(float(low))) / F.lit(float(width)))
    return F.least(F.greatest(raw, F.lit(0).cast("bigint")), F.lit(bins - 1).cast("bigint")).cast("int")


def bin_edge(number: Column, low: float, width: float) -> Column:
    """Left edge of a bin."""
    return F.lit(float(low)) + number * F.lit(float(width))
