"""Renaming driven by a mapping relation, as schema or as data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def one_pair_per_name(mapping: DataFrame, names: Sequence[str]) -> DataFrame:
    """The pairs about ``names``, one for each: that with the least new name. The rule does not depend on
    the order or partitioning of the mapping."""
    relevant = mapping.filter(F.col("sig_name").isin(list(names)) & F.col("sig_mapping_name").isNotNull())
    return relevant.groupBy("sig_name").agg(F.min("sig_mapping_name").alias("sig_mapping_name"))


def rename_columns(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rename the columns of ``df`` that the mapping knows; other columns and other mapping rows are
    left alone. Of several pairs for a name the one with the least new name counts.

    The pairs are aggregated to one per existing column before they reach the driver, so what is
    collected is bounded by the width of the frame and not by the mapping.
    """
    pairs = one_pair_per_name(mapping, df.columns).collect()
    return df.withColumnsRenamed({pair["sig_name"]: pair["sig_mapping_name"] for pair in pairs})


def long_form(df: DataFrame, ids: Sequence[str], name: str = "sig_name", value: str = "value") -> DataFrame:
    """One row per (ids, column): the column's name and value."""
    measures = [column for column in df.columns if column not in ids]
    return df.unpivot(list(ids), measures, name, value)


def map_names(long: DataFrame, mapping: DataFrame, ids: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Resolve ``sig_name`` of long-form rows by joining the mapping; unknown names stay.

    ``names`` are the names that can occur. The mapping is cut to them and to one pair each (the rule of
    ``rename_columns``), so what is broadcast has at most as many rows as there are names.
    """
    pairs = F.broadcast(one_pair_per_name(mapping, names))
    joined = long.join(pairs, "sig_name", "left")
    resolved = F.coalesce("sig_mapping_name", "sig_name").alias("sig_mapping_name")
    return joined.select(*ids, resolved, "value")
