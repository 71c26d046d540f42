"""Scores of a row against the other rows of its group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions import round_to, safe_divide
from wattlake.operators.ranking import top_n_cutoff
from wattlake.operators.slices import _null_safe_join
from wattlake.session import materialise

#: Up to so many groups, of some hundred bytes each, are broadcast.
FEW_GROUPS = 50_000
SALTS = 16
SEVERE_AT = 3
WATCH_AT = 2


def score_against_group(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    top_n: int,
    mean: str = "group_mean",
    deviation: str = "group_sd",
    score: str = "z_score",
    band: str = "anomaly_band",
    leader: str = "is_leader",
) -> DataFrame:
    """Add the group's mean and deviation, the z-score, its band and a top-n flag.

    The group's figures are aggregated and joined back rather than computed by a
    window: a group such as a region may hold most of the table, and its partial
    aggregates are a handful of numbers. Bands use the unrounded score.
    """
    df = materialise(df)  # read for the figures, for the cut-offs and for its rows: computed once
    figures = df.groupBy(*keys).agg(
        F.avg(value).alias(mean), F.stddev_samp(value).alias(deviation)
    )
    cutoffs = top_n_cutoff(df, keys, value, top_n, "_cutoff", "_found")
    groups = materialise(_null_safe_join(figures, cutoffs, keys, "left"))
    # A few numbers a group: sent to the rows when the groups are counted to be few. Otherwise rows
    # are dealt by group and salt, so that a large group is spread.
    if groups.count() <= FEW_GROUPS:
        groups, by = F.broadcast(groups), list(keys)
    else:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int")
        df = df.withColumn("_salt", salt)
        groups = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        by = [*keys, "_salt"]
    z = safe_divide(F.col(value) - F.col(mean), F.col(deviation))
    few = F.coalesce(F.col("_found"), F.lit(0)) < top_n
    return (
        _null_safe_join(df, groups, by, "inner").drop("_salt")
        .withColumn("_z", z)
        .withColumn(score, round_to(F.col("_z"), 3))
        .withColumn(
            band,
            F.when(F.abs("_z") >= SEVERE_AT, "severe")
            .when(F.abs("_z") >= WATCH_AT, "watch")
            .otherwise("normal"),
        )
        .withColumn(leader, few | F.coalesce(F.col(value) >= F.col("_cutoff"), F.lit(False)))
        .drop("_z", "_cutoff", "_found")
    )
