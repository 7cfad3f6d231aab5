"""Order statistics without a sort: the k-th smallest value by histograms of ever finer bins.

Each pass counts the values in bins of their leading bits and goes on in the bins that hold a wanted
rank, so the driver sees a few thousand counts per pass and no rows, and there are at most six passes
for 64 bits. Counts are partial sums in the tasks: a value that a third of all rows have is one of them.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 12  # of one pass
_TOP = 1 << 63
_ALL = (1 << 64) - 1


def double_order(value: Column) -> Column:
    """Whole number that orders like a double: its bits, with those of negative values turned over."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double") + F.lit(0.0)).cast("bigint")
    return bits.bitwiseXOR(F.shiftright(bits, 63).bitwiseAND(F.lit(_TOP - 1)))


def double_of(order: int) -> float:
    """The double with a place in that order."""
    bits = order ^ (_TOP - 1) if order < 0 else order
    return struct.unpack("<d", struct.pack("<q", bits))[0]


def smallest(df: DataFrame, value: Column, ranks: Sequence[int]) -> dict[int, tuple[int, int]]:
    """rank -> (value, rows below it) for ranks from 1 of a whole-number expression; NULLs have no rank.

    A rank beyond the rows is left out.
    """
    rows = df.select(value.cast("bigint").alias("v")).where("v is not null")
    size, low, high = rows.agg(F.count("v"), F.min("v"), F.max("v")).first()
    wanted = {rank: (rank, 0) for rank in set(ranks) if 1 <= rank <= size}  # rank -> (rank in its bin, rows below)
    if not wanted:
        return {}
    found: dict[int, tuple[int, int]] = {}
    unsigned = F.col("v").bitwiseXOR(F.lit(-_TOP))
    shift = max(0, ((low & _ALL) ^ (high & _ALL)).bit_length())
    inside: dict[int, list[int]] | None = None  # leading bits -> ranks that lie there
    while wanted:
        before, shift = shift, max(0, shift - BITS)
        part = rows if inside is None else rows.where(_lead(unsigned, before).isin(sorted(inside)))
        bins = part.groupBy(_lead(unsigned, before).alias("outer"), _lead(unsigned, shift).alias("bin")).agg(
            F.count("v").alias("n"), F.min("v").alias("least"), F.max("v").alias("most")
        )
        counted = sorted(bins.collect(), key=lambda row: row.least)
        below: dict[int, int] = {}
        nxt: dict[int, list[int]] = {}
        for row in counted:
            start = below.get(row.outer, 0)
            below[row.outer] = start + row.n
            for rank in list(wanted) if inside is None else inside.get(row.outer, []):
                own, passed = wanted.get(rank, (0, 0))
                if not start < own <= start + row.n:
                    continue
                if row.least == row.most:
                    found[rank] = row.least, passed + start
                else:
                    nxt.setdefault(row.bin, []).append(rank)
                    found[rank] = 0, passed + start  # filled in by a later pass
        placed = {rank for ranks_there in nxt.values() for rank in ranks_there}
        wanted = {rank: (wanted[rank][0] - (found[rank][1] - wanted[rank][1]), found[rank][1]) for rank in placed}
        inside = nxt
    return found


def _lead(unsigned: Column, shift: int) -> Column:
    return F.shiftrightunsigned(unsigned, shift) if shift < 64 else F.lit(0).cast("bigint")


def quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[float]:
    """Exact quantiles of finite doubles, with linear interpolation between neighbours; none without rows."""
    rows = df.where(F.abs(F.col(column).cast("double")) < F.lit(math.inf)).select(F.col(column).cast("double").alias("x"))
    size = rows.count()
    if not size:
        return []
    places = [(size - 1) * share for share in shares]
    ranks = {r for place in places for r in (math.floor(place) + 1, math.ceil(place) + 1)}
    values = {rank: double_of(order) for rank, (order, _) in smallest(rows, double_order(F.col("x")), sorted(ranks)).items()}
    out = []
    for place in places:
        low, high, part = values[math.floor(place) + 1], values[math.ceil(place) + 1], place - math.floor(place)
        out.append(low + (high - low) * part if part < 0.5 else high - (high - low) * (1 - part))
    return out
