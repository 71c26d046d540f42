"""Ranks and top-n per group without pulling a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.operators.slices import MAX_GROUP_ROWS, SLICE, _null_safe_join, hot_groups


def dense_rank_within(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    rank: str = "rank",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the dense rank of ``value`` (highest first) among the rows of its group.

    In a hot group the rank is taken over the distinct values, which a partial
    aggregation has already collapsed: in-slice rank plus the number of distinct
    values in the higher slices. The ranks return to the rows by an equi-join.
    """
    keys = list(keys)
    hot = hot_groups(df, keys, value, max_group_rows)
    if hot is None:
        by_value = Window.partitionBy(*keys).orderBy(F.col(value).desc_nulls_last())
        return df.withColumn(rank, F.dense_rank().over(by_value).cast("long"))

    values = hot.add_slices(df.select(*keys, value).distinct(), value, nulls_high=False)
    in_slice = Window.partitionBy(*keys, SLICE).orderBy(F.col(value).desc_nulls_last())
    higher = (
        Window.partitionBy(*keys).orderBy(F.col(SLICE).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        values.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_values"))
        .withColumn("_above", F.coalesce(F.sum("_values").over(higher), F.lit(0)))
        .drop("_values")
    )
    ranked = _null_safe_join(
        values.withColumn("_in", F.dense_rank().over(in_slice)), offsets, [*keys, SLICE], "inner"
    ).select(*keys, value, (F.col("_in") + F.col("_above")).cast("long").alias(rank))
    return _null_safe_join(df, ranked, [*keys, value], "inner")


def top_n_cutoff(
    df: DataFrame, keys: Sequence[str], value: str, n: int, cutoff: str = "cutoff", found: str = "found"
) -> DataFrame:
    """Per group: the n-th highest value, counting ties, and how many values there are up to n.

    A row is in the top n by ``rank()`` exactly when its value is not below the
    cutoff, or when the group has fewer than n values. The group limit before
    the shuffle sends at most n rows per group from each task.
    """
    best = Window.partitionBy(*keys).orderBy(F.col(value).desc())
    return (
        df.select(*keys, value).filter(F.col(value).isNotNull())
        .withColumn("_rn", F.row_number().over(best)).filter(F.col("_rn") <= n)
        .groupBy(*keys)
        .agg(F.min(value).alias(cutoff), F.count(F.lit(1)).alias(found))
    )
