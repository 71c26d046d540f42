"""What has changed between two states of a table that says what is in force from when on."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def changed_intervals(
    old: DataFrame, new: DataFrame, keys: Sequence[str], time: str | None = None
) -> DataFrame:
    """``keys, since, until``: where another row is in force in ``new`` than in ``old``; ``until`` is exclusive.

    A row is in force from its ``time`` until the key's next one, and the last one for good (``until`` is NULL).
    Where there is no time it is always in force, and both ends are NULL. Before the first row nothing is. Of rows with one key and time the greatest counts. Rows are compared by all columns
    but the time, NULLs being equal, so a row that repeats its predecessor changes nothing. NULL keys are keys
    like others; rows without a time are never in force. Both snapshots are shuffled once, by key.
    """
    values = [c for c in old.columns if c not in (*keys, time)]
    at = F.col(time) if time else F.lit("1970-01-01").cast("timestamp_ntz")
    # Absent and "all columns NULL" differ, as the struct itself is NULL only where there is no row.
    row = F.struct(F.lit(1).alias("_there"), *values)

    def points(df: DataFrame, name: str) -> DataFrame:
        return df.filter(at.isNotNull()).select(*keys, at.alias("since"), row.alias(name))

    both = points(old, "_old").unionByName(points(new, "_new"), allowMissingColumns=True)
    steps = both.groupBy(*keys, "since").agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    by_time = Window.partitionBy(*keys).orderBy("since")
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_force = steps.select(
        *keys, "since", F.lead("since").over(by_time).alias("until"),
        *(F.last(c, ignorenulls=True).over(so_far).alias(c) for c in ("_old", "_new")),
    )
    differs = ~F.col("_old").eqNullSafe(F.col("_new"))
    since = F.col("since") if time else F.lit(None).cast("timestamp_ntz").alias("since")
    return in_force.filter(differs).select(*keys, since, "until")


def touched_dates(intervals: DataFrame, first: date | Column, last: date | Column, *keys: str) -> DataFrame:
    """``keys, touched``: the dates from ``first`` to ``last`` that the intervals overlap, each once.

    With keys, an interval gives the dates that none of its key's intervals before has given, so dates are never
    compared once they are spelt out; what is sorted, by key, are the intervals.
    """
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (first, last))
    start = F.greatest(F.to_date("since"), low)
    # An open end (NULL) gives way to the other argument. An interval that ends at midnight does not touch
    # the date that begins there.
    until = F.to_date("until")
    end = F.least(F.when(F.col("until") == until.cast("timestamp_ntz"), F.date_sub(until, 1)).otherwise(until), high)
    spans = intervals.select(*keys, start.alias("_start"), end.alias("_end")).filter("_start <= _end")
    if not keys:
        return spans.distinct().select(F.explode(F.sequence("_start", "_end")).alias("touched")).distinct()
    before = Window.partitionBy(*keys).orderBy("_start", "_end").rowsBetween(Window.unboundedPreceding, -1)
    given = spans.withColumn("_given", F.max("_end").over(before))
    own = F.greatest("_start", F.date_add("_given", 1))
    return given.select(*keys, F.explode(F.when(own <= F.col("_end"), F.sequence(own, "_end"))).alias("touched"))
