"""Connected components by alternating stars over DataFrames; nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.session import stage


def _stars(pairs: DataFrame, upper_only: bool) -> DataFrame:
    """Point what lies around each node at the least node around it.

    ``pairs`` holds (u, v); with ``upper_only`` only the neighbours above u are pointed (large star),
    else all of them and u itself (small star, where all neighbours lie below u).
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    if upper_only:  # a node may have very many neighbours above: both sides of the join are plain shuffles,
        least = stage(least, "least")  # which adaptive execution can split
    joined = pairs.join(least, "u")
    if upper_only:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    around = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return around.unionByName(least.select("u", F.col("m").alias("v")))


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b), the component being its least node.

    Edges may repeat and point either way. A node of very many edges is safe: least neighbours are
    aggregated before the shuffle, and joins are left to adaptive execution, which splits hot keys.
    Every round is written to the shared folder, so a lost executor costs one round.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = stage(pairs, "edges")
    state = _state(pairs)
    while state[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, upper_only=True).distinct()
        pairs = stage(_stars(large, upper_only=False).where("u <> v").distinct(), "edges")
        before, state = state, _state(pairs)
        if state == before:
            break
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
