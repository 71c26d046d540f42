"""Operators over the time-ordered rows of a key: latest version, difference, split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.operators.slices import CARRIED, MAX_GROUP_ROWS, SLICE, hot_groups


def _newest_first(df: DataFrame, keys: Sequence[str], version: str) -> list[Column]:
    """Version, then every other column: a total order, so equal versions do not race."""
    rest = [c for c in df.columns if c not in keys and c != version]
    return [F.col(c).desc_nulls_last() for c in (version, *rest)]


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """One row per key, the one with the highest ``version``.

    Catalyst turns the filter on the row number into a group limit before *and*
    after the shuffle, so a key with very many copies leaves each task as one row.
    """
    newest = Window.partitionBy(*keys).orderBy(*_newest_first(df, keys, version))
    return df.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def _with_previous(df: DataFrame, by: Sequence[str], time: str, previous: Mapping[str, str]) -> DataFrame:
    before = Window.partitionBy(*by).orderBy(F.col(time).asc_nulls_last())
    return df.withColumns({name: F.lag(source).over(before) for name, source in previous.items()})


def previous_by_key(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    previous: Mapping[str, str],
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add columns of the row before, ``{new column: source column}``, along each key.

    ``time`` must be unique within a key. A key with more than ``max_group_rows``
    rows is walked in slices, each seeded with the last row of the one before.
    """
    hot = hot_groups(df, keys, time, max_group_rows)
    if hot is None:
        return _with_previous(df, keys, time, previous)
    sliced = hot.add_slices(df, time)
    seeds = hot.carry_last(sliced, [time], F.col(time).isNotNull())
    rows = sliced.withColumn(CARRIED, F.lit(False)).unionByName(seeds.withColumn(CARRIED, F.lit(True)))
    return (
        _with_previous(rows, [*keys, SLICE], time, previous)
        .filter(~F.col(CARRIED)).drop(CARRIED, SLICE)
    )


def difference_by_key(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    *,
    previous_value: str = "prev_value",
    previous_time: str = "prev_time",
    difference: str = "difference",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the previous row's value and time, and the step from it to this row."""
    previous = {previous_value: value, previous_time: time}
    return previous_by_key(df, keys, time, previous, max_group_rows).withColumn(
        difference, F.col(value) - F.col(previous_value)
    )


def dedupe_and_difference(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    version: str,
    value: str,
    *,
    previous_value: str,
    previous_time: str,
    difference: str,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Latest version of each (keys, time), then the difference along each key.

    Sorted by key, time and version, both steps read off neighbouring rows: a row is
    the latest of its time if the next row has another time. One shuffle and one
    sort serve both. That needs every key to fit a task with all its copies, so
    it is measured; otherwise copies are dropped before the shuffle and hot keys sliced.
    """
    if hot_groups(df, keys, time, max_group_rows) is None:
        rest = [c for c in df.columns if c not in keys and c not in (time, version)]
        by_version = Window.partitionBy(*keys).orderBy(
            F.col(time).asc_nulls_last(), *(F.col(c).asc_nulls_first() for c in (version, *rest))
        )
        following = F.lead(F.struct(time)).over(by_version)
        latest = (
            df.withColumn("_next", following)
            .filter(F.col("_next").isNull() | ~F.col("_next")[time].eqNullSafe(F.col(time)))
            .drop("_next")
        )
        return _with_previous(
            latest, keys, time, {previous_value: value, previous_time: time}
        ).withColumn(difference, F.col(value) - F.col(previous_value))
    return difference_by_key(
        latest_per_key(df, [*keys, time], version), keys, time, value,
        previous_value=previous_value, previous_time=previous_time,
        difference=difference, max_group_rows=max_group_rows,
    )


def split_rows(df: DataFrame, reason: str) -> tuple[DataFrame, DataFrame]:
    """Rows without and rows with a reject reason."""
    return df.filter(F.col(reason).isNull()), df.filter(F.col(reason).isNotNull())


def with_day_boundary(
    df: DataFrame, keys: Sequence[str], day: str, time: str, value: str, previous: str,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the previous row's value, looking back into the day before if need be.

    Each day is computed as if it had read its own rows and those of the day
    before, which only serve as seed. Only the last row of a key and day can be
    that seed, so one pre-aggregated row per key and day is carried over.
    """
    seeds = df.groupBy(*keys, day).agg(
        F.max_by(F.struct(value), F.struct(time)).alias("_seed")
    ).withColumn(day, F.date_add(day, 1))
    within = previous_by_key(
        df, [*keys, day], time, {"_before": value, "_before_time": time}, max_group_rows
    )
    return (
        within.join(seeds, [*keys, day], "left")
        .withColumn(
            previous,
            F.when(F.col("_before_time").isNull(), F.col("_seed")[value]).otherwise(F.col("_before")),
        )
        .select(*df.columns, previous)
    )
