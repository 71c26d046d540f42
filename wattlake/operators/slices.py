"""Splitting of hot groups for ordered window functions.

A window keeps a whole group in one task. That is fine for thousands of groups
of a similar size and hopeless when one of them holds a third of the table. The
helpers here measure the groups first. Only those above a fixed number of rows are
cut into *slices*: consecutive ranges of the ordering column, as Spark's own range
partitioning finds them. A window then runs per (key, slice), and what a slice needs
from the earlier ones travels in one carried row per slice.

The limit does not depend on the size of the table, and neither keys nor cut points
reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.session import materialise

#: Rows one task sorts and walks through without becoming a straggler.
MAX_GROUP_ROWS = 2_000_000

#: Keys are counted by hash first; no key is hotter than its bucket is full.
_BUCKETS = 65_536

SLICE = "_slice"
CARRIED = "_carried"
_HOT = "_hot"


@dataclass(frozen=True)
class HotGroups:
    """The keys above the limit, and how many slices all their rows make."""

    hot: DataFrame
    keys: tuple[str, ...]
    slices: int

    def add_slices(self, df: DataFrame, order: str, nulls_high: bool = True) -> DataFrame:
        """Add ``_slice``: 0 outside hot groups, else the range ``order`` falls into.

        A value always lands in the slice of its equals, so ties stay together. The hot rows are dealt by
        ranges of key and value and written once, because the ranges are those of one deal.
        """
        marked = _null_safe_join(df, self.hot.withColumn(_HOT, F.lit(True)), self.keys, "left")
        cold = marked.filter(F.col(_HOT).isNull()).drop(_HOT).withColumn(SLICE, F.lit(0))
        value = F.col(order).asc_nulls_last() if nulls_high else F.col(order).asc_nulls_first()
        hot = (
            marked.filter(_HOT).drop(_HOT)
            .repartitionByRange(self.slices, *self.keys, value)
            .withColumn(SLICE, F.spark_partition_id() + 1)
        )
        return cold.unionByName(materialise(hot))

    def carry_last(self, sliced: DataFrame, order: Sequence[str], of: Column | None = None) -> DataFrame:
        """For each slice, the last row (by ``order``) of the slices before it; rows for which ``of`` holds count.

        Pre-aggregated per slice, so the window below only sees one row per slice.
        """
        columns = sliced.columns
        row = F.struct(*columns) if of is None else F.when(of, F.struct(*columns))
        at = F.struct(*order) if of is None else F.when(of, F.struct(*order))
        tails = (
            sliced.filter(F.col(SLICE) > 0).groupBy(*self.keys, SLICE)
            .agg(F.max_by(row, at).alias("_tail"))
        )
        earlier = (
            Window.partitionBy(*self.keys).orderBy(SLICE)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return (
            tails.withColumn("_tail", F.last("_tail", ignorenulls=True).over(earlier))
            .filter(F.col("_tail").isNotNull())
            .select(F.col(SLICE).alias("_target"), "_tail.*")
            .withColumn(SLICE, F.col("_target"))
            .select(*columns)
        )


def hot_groups(
    df: DataFrame, keys: Sequence[str], order: str, max_group_rows: int = MAX_GROUP_ROWS
) -> HotGroups | None:
    """Measure the groups of ``df``; None when a plain window will do.

    Costs one pass over the key columns that shuffles at most _BUCKETS rows from each task: a key is never
    larger than its bucket. Only if a bucket is too full are the keys of such buckets counted themselves.
    """
    keys = tuple(keys)
    bucketed = df.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS)).cast("int").alias("_bucket"))
    buckets = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    full = [r["_bucket"] for r in buckets.filter(F.col("_n") > max_group_rows).collect()]  # at most _BUCKETS
    if not full:
        return None
    crowded = df.sparkSession.createDataFrame([(b,) for b in full], "_bucket int")
    counts = materialise(
        bucketed.join(F.broadcast(crowded), "_bucket", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > max_group_rows)
    )
    rows = counts.agg(F.sum("_n")).first()[0]
    if not rows:
        return None
    # Ranges are found from a sample; twice as many as needed leaves room for its error.
    return HotGroups(counts.select(*keys), keys, 2 * -(-rows // max_group_rows))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys meet, as they do in a window partition."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys))
    return left.join(renamed, condition, how).drop(*(f"_r_{k}" for k in keys))
