"""The reports a run leaves behind, as functions from tables to a table."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from wattlake.functions import round_to


def _of_date(df: DataFrame, day: date | None) -> DataFrame:
    return df if day is None else df.filter(F.col("business_date") == F.lit(day))


def _of_latest_run(df: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows of the run that started last."""
    # One row, so its size is certain.
    newest = runs.agg(F.max_by("run_id", F.struct("started_at", "run_id")).alias("run_id"))
    return df.join(F.broadcast(newest), "run_id", "left_semi")


def runs(runs: DataFrame, day: date | None = None, limit: int = 10) -> DataFrame:
    """Runs, newest first, with their length in seconds and the start of the error."""
    seconds = F.timestamp_diff("SECOND", F.col("started_at"), F.col("finished_at"))
    return (
        _of_date(runs, day).orderBy(F.col("started_at").desc_nulls_last(), "run_id").limit(limit)
        .select(
            "run_id", "business_date", "mode", "status", "rows_published",
            round_to(seconds, 1).alias("secs"),
            F.nullif(F.left("error", F.lit(60)), F.lit("")).alias("error"),
        )
    )


def latest_step_metrics(step_metrics: DataFrame, runs: DataFrame) -> DataFrame:
    return _of_latest_run(step_metrics, runs).select(
        "step_key", "layer", "state", "attempts", "rows_in", "rows_out", "rows_rejected",
        round_to(F.col("duration_seconds"), 2).alias("secs"), "memory_limit", "threads", "sla_breached",
    ).orderBy("layer", "step_key")


def latest_failed_checks(dq_results: DataFrame, runs: DataFrame) -> DataFrame:
    return (
        _of_latest_run(dq_results, runs).filter(~F.col("passed"))
        .select("step_key", "check_name", "severity", "observed", "expected")
        .orderBy("severity", "step_key", "check_name")
    )


def publishes(publish_log: DataFrame, day: date | None = None, limit: int = 20) -> DataFrame:
    return (
        _of_date(publish_log, day)
        .orderBy(F.col("published_at").desc_nulls_last(), "run_id", "table_name").limit(limit)
        .select(
            "run_id", "table_name", "business_date", "rows_deleted", "rows_written",
            F.nullif(F.col("previous_run_id"), F.lit("")).alias("replaced_run"), "compensated",
        )
    )


def steps_of_run(step_metrics: DataFrame, run_id: str) -> DataFrame:
    return (
        step_metrics.filter(F.col("run_id") == run_id).orderBy("layer", "step_key")
        .select(
            "step_key", "state", "attempts", "rows_in", "rows_out", "rows_rejected",
            round_to(F.col("duration_seconds"), 2).alias("secs"),
            F.col("memory_limit").alias("mem"), F.col("threads").alias("thr"),
        )
    )


def latest_lineage(lineage: DataFrame, runs: DataFrame) -> DataFrame:
    return (
        _of_latest_run(lineage, runs)
        .select("upstream", F.lit("->").alias("dir"), "downstream", "step_key").distinct()
        .orderBy("step_key", "upstream", "downstream")
    )


def daily_by_region(daily: DataFrame, limit: int = 20) -> DataFrame:
    return (
        daily.orderBy(F.col("business_date").desc(), "rank_in_day", "region").limit(limit)
        .select(
            "business_date", "region", "meters", "kwh", "cost_eur", "peak_share_pct",
            "kwh_per_meter", "kwh_7d_avg", "rank_in_day",
        )
    )


def flagged_meters(anomalies: DataFrame, limit: int = 20) -> DataFrame:
    return (
        anomalies.filter(F.col("anomaly_band") != "normal")
        .orderBy(F.abs("z_score").desc_nulls_last(), "business_date", "meter_id").limit(limit)
        .select(
            "business_date", "region", "meter_id", "capacity_kw", "kwh", "kwh_per_kw",
            "z_score", "anomaly_band",
        )
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of every table; the counts read no columns."""
    counts = None
    for name, df in sorted(tables.items()):
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def run_rollup(step_metrics: DataFrame, runs: DataFrame) -> DataFrame:
    """Per run: steps that succeeded and failed, rows published."""
    steps = step_metrics.groupBy("run_id").agg(
        F.count_if(F.col("state") == "succeeded").alias("steps_succeeded"),
        F.count_if(F.col("state") == "failed").alias("steps_failed"),
    )
    return steps.join(runs.select("run_id", "status", "rows_published"), "run_id")


def sla_breaches(step_metrics: DataFrame) -> DataFrame:
    """Steps that took longer than their budget."""
    return step_metrics.filter(F.col("duration_seconds") > F.col("sla_seconds")).select(
        "run_id", "step_key", "sla_seconds", "duration_seconds"
    )


#: Quartiles are exact up to so many rows and off by at most a millionth of the ranks beyond.
PROFILE_ACCURACY = 1_000_000


def column_profile(df: DataFrame, exact_distinct: bool = False) -> DataFrame:
    """One row a column: rows, share of nulls, distinct values, least and greatest, and quartiles of numbers.

    All of it is one aggregate whose state is of a fixed size, so nothing but that state is shuffled. Exact
    distinct counts shuffle every distinct value of every column and are for tables of a known size. A table
    without rows has null shares and extremes.
    """
    numeric = {f.name: isinstance(f.dataType, NumericType) for f in df.schema.fields}
    cells = []
    for name, is_number in numeric.items():
        value = F.col(f"`{name}`")
        quartiles = F.percentile_approx(value.cast("double"), [0.25, 0.5, 0.75], PROFILE_ACCURACY) if is_number else F.lit(None).cast("array<double>")
        text = lambda x: (F.lit(None) if is_number else x).cast("string")  # noqa: B023, E731
        number = lambda x: (x if is_number else F.lit(None)).cast("double")  # noqa: B023, E731
        cells.append(F.struct(
            F.lit(name).alias("column_name"), F.count(F.lit(1)).alias("rows"),
            (F.count_if(value.isNull()) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("null_share"),
            (F.count_distinct(value) if exact_distinct else F.approx_count_distinct(value)).alias("distinct_values"),
            number(F.min(value)).alias("least"), number(F.max(value)).alias("greatest"),
            text(F.min(value)).alias("first_text"), text(F.max(value)).alias("last_text"),
            quartiles.alias("q"),
        ))
    return df.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("c")).select(
        "c.column_name", "c.rows", "c.null_share", "c.distinct_values", "c.least", "c.greatest", "c.first_text", "c.last_text",
        F.get("c.q", 0).alias("lower_quartile"), F.get("c.q", 1).alias("median"), F.get("c.q", 2).alias("upper_quartile"),
    )
