"""As-of join: each left row meets the latest right row of its key at or before its time.

Three plans, chosen by measuring the right side:

``broadcast``  The right side is small. Each right row becomes the interval until
               its successor, cut into time buckets, and is broadcast; a left row
               looks up (key, bucket) and only tests the few intervals in there.
               The left side, usually the fact table, is not shuffled at all.
``bucketed``   The same intervals and buckets for a right side of any size: both sides are
               shuffled once by (key, bucket), each bucket holds one interval carried into
               it and those that begin there. Buckets are as wide as keeps these entries
               within a small multiple of the right rows, and adaptive execution splits a
               bucket that many left rows fall into, as in any join.
``sorted``     Where right rows crowd, or keys have few rows each, so that no width does. The distinct keys and times of both sides go through one shuffle by key and
               one sort by time, and a running "last right row" is read off and joined
               back by key and time. Keys with very many times are walked in slices, each
               given the right row in force at its start. There is no bound on either side.

A private nested-loop form and an all-pairs range join are deliberately not used.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from wattlake.functions import epoch_hours
from wattlake.operators.slices import CARRIED, MAX_GROUP_ROWS, SLICE, hot_groups

#: Upper bound of what the broadcast plan may ship to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

#: Bucket widths to choose from, in hours.
_WIDTHS = (1, 6, 24, 24 * 7, 24 * 30, 24 * 365)

#: Right sides with more rows are not considered for broadcasting at all.
_BROADCAST_ROWS = 100_000

#: Most intervals a left row may have to test within one bucket.
_CROWDED = 1_000

#: Entries of the bucketed plan for each right row; half of them on average are carried ones.
_ENTRIES = 4

_EPOCH = date(1970, 1, 1)

_PAYLOAD = "_right"


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    how: str = "inner",
    *,
    allow_exact: bool = True,
    strategy: str = "auto",
    focus: tuple[date, date] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Left columns followed by the right side's non-key columns.

    ``how`` is ``inner`` or ``left``; ``allow_exact=False`` asks for strictly
    earlier right rows. Of right rows with equal key and time the greatest by its
    remaining columns counts, so there is at most one match and the result is
    the same on every run. NULL keys and times match nothing.

    ``focus`` names the dates most left rows lie in. It does not change the result:
    it lets the broadcast plan keep narrow buckets where they matter although some
    right rows, such as a first price, have been in force for decades.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    if strategy not in ("auto", "broadcast", "bucketed", "sorted"):
        raise ValueError(f"unknown strategy {strategy!r}")
    on = list(on)
    extra = [c for c in right.columns if c not in on]
    clash = [c for c in extra if c in left.columns]
    if clash:
        raise ValueError(f"columns on both sides: {clash}")

    right = _present(right, on, right_time)
    plan, small = None, True
    if strategy != "sorted":
        # Decided from aggregates of the whole right side, whose own size is fixed.
        seen = _measured(right, on, right_time)
        if strategy != "bucketed":
            plan = _bucket_plan(seen, broadcast_bytes, focus)
        if plan is None and strategy == "broadcast":
            raise ValueError("the right side is too large to broadcast")
        if plan is None and (seen.largest or 0) <= max_group_rows:
            plan, small = _wide_plan(seen), False
        if plan is None and strategy == "bucketed":
            raise ValueError("right rows crowd: no width of buckets keeps them few")
    if plan is not None:
        joined = _by_buckets(left, right, on, left_time, right_time, how, allow_exact, plan, small)
    else:
        joined = _by_sort(left, right, on, left_time, right_time, how, allow_exact, max_group_rows)
    return joined.select(*left.columns, *(F.col(_PAYLOAD)[c].alias(c) for c in extra))


def _present(right: DataFrame, on: list[str], time: str) -> DataFrame:
    """Keys, time and a struct of the non-key columns, without NULL keys or times.

    The payload travels as a struct so that "no match" and "matched a row whose
    columns are NULL" stay different things.
    """
    payload = F.struct(*(c for c in right.columns if c not in on))
    given = reduce(Column.__and__, (F.col(c).isNotNull() for c in [*on, time]))
    return right.filter(given).select(*on, time, payload.alias(_PAYLOAD))


def _measured(right: DataFrame, on: list[str], time: str) -> Row:
    """Rows, keys, covered hours, rows of the largest key, rows in a key's fullest hour, the widest row as text,
    and by width of buckets the most rows a bucket can have; one job, whose groups are combined before each shuffle.

    A bucket has no more rows than its key, nor than its hours could have if all were like the key's fullest.
    """
    per_hour = right.groupBy(
        *on, epoch_hours(F.col(time), right.schema[time].dataType).alias("_hour")
    ).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(F.octet_length(F.to_json(F.struct(time, _PAYLOAD)))).alias("_width"),
    )
    per_key = per_hour.groupBy(*on).agg(
        F.sum("_n").alias("_n"), F.max("_n").alias("_fullest"), F.min("_hour").alias("_first"),
        F.max("_hour").alias("_last"), F.max("_width").alias("_width"),
    )
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("keys"), F.min("_first").alias("first"),
        F.max("_last").alias("last"), F.max("_n").alias("largest"), F.max("_fullest").alias("fullest"),
        F.max("_width").alias("widest"),
        F.array(*(F.max(F.least("_n", F.col("_fullest") * width)) for width in _WIDTHS)).alias("crowds"),
    ).first()


def _wide_plan(seen: Row) -> tuple[int, int, int] | None:
    """The narrowest bucket with which the intervals make few entries and no bucket is crowded."""
    if not seen.rows:
        return _WIDTHS[0], 0, 0
    for width, crowd in zip(_WIDTHS, seen.crowds, strict=True):
        buckets = (seen.last - seen.first) // width + 4
        if seen.keys * buckets <= (_ENTRIES - 1) * max(seen.rows, _BROADCAST_ROWS) and crowd <= _CROWDED:
            return width, seen.first, seen.last
    return None


def _bucket_plan(
    seen: Row, budget: int, focus: tuple[date, date] | None = None
) -> tuple[int, int, int] | None:
    """The narrowest bucket with which the right side is certain to fit ``budget`` bytes
    and no bucket is crowded, and the first and last hour to cut into buckets.
    """
    rows, keys, first, last, widest = seen.rows, seen.keys, seen.first, seen.last, seen.widest
    if not rows:
        return _WIDTHS[0], 0, 0
    if rows > _BROADCAST_ROWS:
        return None
    if focus is not None:
        from_hour, to_hour = ((day - _EPOCH).days * 24 for day in (focus[0], focus[1] + timedelta(days=1)))
        first, last = max(first, from_hour), min(last, to_hour - 1)
        last = max(first, last)
    for width, crowd in zip(_WIDTHS, seen.crowds, strict=True):
        buckets = (last - first) // width + 4
        # Intervals of a key tile its time line: one entry per bucket, one more per start.
        fits = (rows + keys * buckets) * (widest + 128) <= budget
        if fits and crowd <= _CROWDED:
            return width, first, last
    return None


def _by_buckets(left, right, on, left_time, right_time, how, allow_exact, plan, small):
    width, first_hour, last_hour = plan
    # One bucket before and one after take everything outside the hours cut up.
    before = F.lit(first_hour // width - 1).cast("long")
    after = F.lit(last_hour // width + 1).cast("long")

    def bucket(name: str, dtype) -> Column:
        hour = epoch_hours(F.col(name), dtype)
        number = hour if width == 1 else F.floor(hour / width)
        return F.greatest(F.least(number, after), before)

    time_type = right.schema[right_time].dataType
    successor = Window.partitionBy(*on).orderBy(right_time)
    until_bucket = F.when(F.col("_until").isNull(), after).otherwise(bucket("_until", time_type))
    # Known to be small, all is in one partition and needs no shuffles; else one shuffle by key serves both steps.
    together = right.coalesce(1) if small else right.repartition(*on)
    intervals = (
        together.groupBy(*on, right_time).agg(F.max(_PAYLOAD).alias(_PAYLOAD))
        .withColumn("_until", F.lead(right_time).over(successor))
        .withColumn(
            "_b",
            F.explode(F.sequence(bucket(right_time, time_type), until_bucket)),
        )
        .select(
            *(F.col(k).alias(f"_k_{k}") for k in on), "_b",
            F.col(right_time).alias("_since"), "_until", _PAYLOAD,
        )
    )
    now = F.col(left_time)
    if allow_exact:
        in_force = (now >= F.col("_since")) & (F.col("_until").isNull() | (now < F.col("_until")))
    else:
        in_force = (now > F.col("_since")) & (F.col("_until").isNull() | (now <= F.col("_until")))
    here = bucket(left_time, left.schema[left_time].dataType)
    same_key = reduce(Column.__and__, (F.col(k) == F.col(f"_k_{k}") for k in on))
    met = F.broadcast(intervals) if small else intervals.hint("merge")
    return left.join(met, same_key & (here == F.col("_b")) & in_force, how)


def _by_sort(left, right, on, left_time, right_time, how, allow_exact, max_group_rows):
    """Matches the distinct keys and times of the left side, and gives its rows their match by both.

    Rows that share key and time, however many, meet the sorted pass as one, and the join back is by key
    and time, which spreads them like any skewed join.
    """
    matchable = reduce(Column.__and__, (F.col(c).isNotNull() for c in [*on, left_time]))
    payload_type = right.schema[_PAYLOAD].dataType
    # At equal times the right row has to come first to be seen, or last not to be.
    first, second = (0, 1) if allow_exact else (1, 0)
    events = (
        left.filter(matchable).select(*on, left_time).distinct()
        .select(*on, left_time, F.lit(None).cast(payload_type).alias(_PAYLOAD), F.lit(second).alias("_side"))
        .unionByName(
            # Of several right rows at one time the greatest payload is in force.
            right.groupBy(*on, F.col(right_time).alias(left_time)).agg(F.max(_PAYLOAD).alias(_PAYLOAD))
            .withColumn("_side", F.lit(first))
        )
    )
    hot = hot_groups(events.select(*on, left_time), on, left_time, max_group_rows)
    by = list(on)
    if hot is not None:
        events = hot.add_slices(events, left_time)
        by.append(SLICE)
        in_force = hot.carry_last(events, [left_time], F.col("_side") == first)
        events = events.withColumn(CARRIED, F.lit(False)).unionByName(
            in_force.withColumn(CARRIED, F.lit(True))
        )
    so_far = (
        Window.partitionBy(*by).orderBy(left_time, "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matched = (
        events.withColumn(_PAYLOAD, F.last(_PAYLOAD, ignorenulls=True).over(so_far))
        .filter((F.col("_side") == second) & F.col(_PAYLOAD).isNotNull())
        .select(*(F.col(k).alias(f"_m_{k}") for k in [*on, left_time]), _PAYLOAD)
    )
    met = reduce(Column.__and__, (F.col(k) == F.col(f"_m_{k}") for k in [*on, left_time]))
    return left.join(matched, met, how).drop(*(f"_m_{k}" for k in [*on, left_time]))
