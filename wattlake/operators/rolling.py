"""Rolling means over calendar days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.operators.slices import _null_safe_join


def days_back(keys: Sequence[str], day: str, days: int):
    """Window over this day and the ``days - 1`` calendar days before it."""
    return Window.partitionBy(*keys).orderBy(F.unix_date(day)).rangeBetween(-(days - 1), 0)


def rolling_mean_by_days(
    df: DataFrame, keys: Sequence[str], day: str, value: Column | str, out: str, days: int = 7
) -> DataFrame:
    """Add the mean of ``value`` over the group's last ``days`` calendar days.

    Rows of a day are peers of a RANGE frame, so a day only matters by its sum and
    count. Those are pre-aggregated; the window sees one row per group and day.
    """
    value = F.col(value) if isinstance(value, str) else value
    daily = df.groupBy(*keys, day).agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    frame = days_back(keys, day, days)
    means = daily.select(
        *keys, day, (F.sum("_sum").over(frame) / F.nullif(F.sum("_n").over(frame), F.lit(0))).alias(out)
    )
    return _null_safe_join(df, means, [*keys, day], "inner")
