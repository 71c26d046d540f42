"""Equi-joins. No side is broadcast by hand: adaptive execution broadcasts a side it
has measured to be small and splits the partitions of a hot key otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dimension_join(
    facts: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Inner join that keeps one key column; facts without a dimension row are dropped."""
    return facts.join(dimension.select(key, *columns), key, "inner")


def orphans(child: DataFrame, parent: DataFrame, column: str, parent_column: str) -> DataFrame:
    """Child rows whose value is absent from the parent; a NULL counts as absent."""
    known = parent.select(F.col(parent_column).alias("_parent"))
    return child.join(known, F.col(column) == F.col("_parent"), "left_anti")
