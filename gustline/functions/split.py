"""Deterministic train/test assignment from a row's own key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Knuth's multiplicative hash (2^32 divided by the golden ratio), which spreads runs
# of consecutive keys evenly over [0, 1).
MULTIPLIER = 2654435761
MODULUS = 2**32
KEY_RANGE = 2**31


def split_rank(key: Column, seed: int = 42) -> Column:
    """Place of an integer key among 2^32. Depends on the key alone, so the split is the same for any
    partitioning, file layout or retry; keys that differ by less than 2^31 have different places."""
    bounded = F.pmod(key.cast("bigint") + F.lit(seed).cast("bigint"), F.lit(KEY_RANGE).cast("bigint"))
    return F.pmod(bounded * F.lit(MULTIPLIER).cast("bigint"), F.lit(MODULUS).cast("bigint"))


def split_position(key: Column, seed: int = 42) -> Column:
    """Position of an integer key in [0, 1)."""
    return split_rank(key, seed).cast("double") / F.lit(float(MODULUS))


def hour_key(day: str = "signal_date", hour: str = "hour") -> Column:
    """Integer key of an hourly row: hours since the epoch."""
    return F.unix_date(F.col(day)).cast("bigint") * F.lit(24) + F.col(hour)
