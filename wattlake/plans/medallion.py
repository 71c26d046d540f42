"""The data products: bronze, silver and gold, as functions from frames to frames.

Each function takes the frames of one date or of many; ``business_date`` tells the
rows apart. With ``scope="run"`` windows and group figures stay inside a date, so a
job over many dates gives what separate runs per date would. ``scope="history"``
lets the first reading of a day look back at the day before and the rolling mean at
six days before; what of those is not in the run comes in as ``day_before`` and
``earlier_days``, so runs of single dates, oldest first, give the same as well.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions import round_to, safe_divide, to_hour
from wattlake.operators import (
    asof_join,
    dedupe_and_difference,
    difference_by_key,
    dimension_join,
    latest_per_key,
    score_against_group,
)
from wattlake.operators.rolling import days_back
from wattlake.operators.slices import MAX_GROUP_ROWS
from wattlake.plans.catalog import HIGH_VOLTAGE, LOW_VOLTAGE, PEAK_HOURS, SPIKE_KWH, TOP_METERS

Frames = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Options:
    spike_kwh: float = SPIKE_KWH
    scope: str = "run"
    max_group_rows: int = MAX_GROUP_ROWS
    dates: tuple[date, date] | None = None
    """First and last date being worked on, if known; only used to plan."""


def _typed(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(*(c.alias(name) for name, c in columns.items()))


def bronze_readings(frames: Frames, options: Options) -> DataFrame:
    return _typed(
        frames["landing_readings"],
        meter_id=F.col("meter_id").cast("string"),
        reading_ts=F.col("ts").cast("timestamp_ntz"),
        cumulative_kwh=F.col("cumulative_kwh").cast("double"),
        voltage=F.col("voltage").cast("double"),
        quality_flag=F.col("quality_flag").cast("string"),
        src_updated_at=F.col("src_updated_at").cast("timestamp_ntz"),
        business_date=F.col("dt").cast("date"),
    )


def bronze_meters(frames: Frames, options: Options) -> DataFrame:
    return _typed(
        frames["landing_meters"],
        meter_id=F.col("meter_id").cast("string"),
        region=F.lower("region"),
        tariff_plan=F.lower("tariff_plan"),
        install_date=F.col("install_date").cast("date"),
        capacity_kw=F.col("capacity_kw").cast("double"),
        customer_segment=F.lower("customer_segment"),
    )


def bronze_tariffs(frames: Frames, options: Options) -> DataFrame:
    return _typed(
        frames["landing_tariffs"],
        tariff_plan=F.lower("tariff_plan"),
        valid_from=F.col("valid_from").cast("timestamp_ntz"),
        price_per_kwh=F.col("price_per_kwh").cast("double"),
        currency=F.upper("currency"),
    )


def bronze_weather(frames: Frames, options: Options) -> DataFrame:
    weather = frames["landing_weather"]
    dated = {"dt": F.col("dt")} if "dt" in weather.columns else {}
    return _typed(
        weather,
        region=F.lower("region"),
        observed_at=F.col("ts").cast("timestamp_ntz"),
        temp_c=F.col("temp_c").cast("double"),
        **dated,
    )


def reject_reason(spike_kwh: float = SPIKE_KWH) -> Column:
    """Why a reading is not accepted, NULL if it is; the first reason that holds counts.

    A NULL voltage is neither in nor out of range and is accepted.
    """
    return (
        F.when(F.col("cumulative_kwh").isNull(), "null_reading")
        .when(F.col("prev_kwh").isNull(), "no_prior_reading")
        .when(F.col("interval_kwh") < 0, "meter_rollback")
        .when(F.col("interval_kwh") > spike_kwh, "implausible_spike")
        .when(~F.col("voltage").between(LOW_VOLTAGE, HIGH_VOLTAGE), "voltage_out_of_range")
    )


def classified_readings(readings: DataFrame, options: Options) -> DataFrame:
    """Latest version of each reading, its interval and its reject reason.

    The difference is taken before anything is rejected: after a NULL reading the
    next has no prior one, and the return from a spike is a rollback.
    """
    names = {"previous_value": "prev_kwh", "previous_time": "prev_ts", "difference": "interval_kwh"}
    keys = ["meter_id", "business_date"]
    if options.scope == "run":
        stepped = dedupe_and_difference(
            readings, keys, "reading_ts", "src_updated_at", "cumulative_kwh", **names, max_group_rows=options.max_group_rows
        )
    else:
        stepped = _across_midnight(readings, keys, names, options)
    return (
        stepped
        .withColumn("reject_reason", reject_reason(options.spike_kwh))
        .withColumn("interval_kwh", round_to(F.col("interval_kwh"), 4))
    )


def _across_midnight(readings: DataFrame, keys: list[str], names: Mapping[str, str], options: Options) -> DataFrame:
    """Differences in which a day's first reading follows the last one of the day before, if there is any.

    Only one row per meter and day is carried over, pre-aggregated.
    """
    latest = latest_per_key(readings, ["meter_id", "reading_ts"], "src_updated_at")
    within = difference_by_key(
        latest, keys, "reading_ts", "cumulative_kwh", **names, max_group_rows=options.max_group_rows
    )
    seeds = latest.groupBy(*keys).agg(
        F.max_by(F.struct("cumulative_kwh", "reading_ts"), "reading_ts").alias("_seed")
    ).withColumn("business_date", F.date_add("business_date", 1))
    first = F.col("prev_ts").isNull() & F.col("_seed").isNotNull()
    return within.join(seeds, keys, "left").withColumns({
        "prev_kwh": F.when(first, F.col("_seed.cumulative_kwh")).otherwise(F.col("prev_kwh")),
        "prev_ts": F.when(first, F.col("_seed.reading_ts")).otherwise(F.col("prev_ts")),
    }).withColumn("interval_kwh", F.col("cumulative_kwh") - F.col("prev_kwh")).drop("_seed")


def accepted(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reject_reason").isNull()).select(
        "meter_id", "reading_ts", "business_date", "cumulative_kwh", "interval_kwh",
        "voltage", "quality_flag", "src_updated_at",
    )


def quarantined(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reject_reason").isNotNull()).select(
        "meter_id", "reading_ts", "business_date", "cumulative_kwh", "prev_kwh", "prev_ts",
        "interval_kwh", "voltage", "reject_reason",
    )


def silver_cleanse(frames: Frames, options: Options) -> DataFrame:
    """Accepted and rejected rows in one frame, told apart by the column ``dataset``.

    One pass serves both outputs: the writer sorts the rows into their folders.
    Columns that only one of the two has are NULL in the other.
    """
    readings, before = frames["bronze_readings"], frames.get("day_before")
    if options.scope == "history" and before is not None:
        known = readings.withColumn("_own", F.lit(True)).unionByName(before.withColumn("_own", F.lit(False)))
        rows = classified_readings(known, options).filter("_own").drop("_own")
    else:
        rows = classified_readings(readings, options)
    rejected = F.col("reject_reason").isNotNull()
    only_rejected, only_accepted = ("prev_kwh", "prev_ts"), ("quality_flag", "src_updated_at")
    return rows.withColumns(
        {c: F.when(rejected, F.col(c)) for c in only_rejected}
        | {c: F.when(~rejected, F.col(c)) for c in only_accepted}
        | {"dataset": F.when(rejected, "silver_quarantine").otherwise("silver_readings")}
    )


def silver_enrich(frames: Frames, options: Options) -> DataFrame:
    """The meter, the price and the weather in force at each reading, and the cost."""
    with_meter = dimension_join(
        frames["silver_readings"], frames["bronze_meters"], "meter_id",
        ["region", "tariff_plan", "capacity_kw", "customer_segment"],
    )
    priced = asof_join(
        with_meter, frames["bronze_tariffs"], ["tariff_plan"], "reading_ts", "valid_from", "inner",
        focus=options.dates, max_group_rows=options.max_group_rows,
    )
    weather = frames["bronze_weather"]
    place = ["region"]
    if "dt" in weather.columns:
        weather = weather.withColumnRenamed("dt", "business_date")
        place = ["region", "business_date"]
    # Left: a missing observation must not remove consumption.
    observed = asof_join(
        priced, weather, place, "reading_ts", "observed_at", "left",
        focus=options.dates, max_group_rows=options.max_group_rows,
    )
    return observed.drop("valid_from", "observed_at", "src_updated_at").select(
        "*",
        round_to(F.col("interval_kwh") * F.col("price_per_kwh"), 5).alias("cost_eur"),
        to_hour(F.col("reading_ts")).alias("reading_hour"),
        F.hour("reading_ts").between(*PEAK_HOURS).alias("is_peak"),
    )


def daily_totals(enriched: DataFrame) -> DataFrame:
    """One row per date and region. Without a peak row peak_kwh is NULL, not 0."""
    return enriched.groupBy("business_date", "region").agg(
        F.count_distinct("meter_id").alias("meters"),
        round_to(F.sum("interval_kwh"), 3).alias("kwh"),
        round_to(F.sum("cost_eur"), 2).alias("cost_eur"),
        round_to(F.sum(F.when(F.col("is_peak"), F.col("interval_kwh"))), 3).alias("peak_kwh"),
        round_to(F.avg("temp_c"), 2).alias("avg_temp_c"),
    )


def gold_daily_region(frames: Frames, options: Options) -> DataFrame:
    """Daily totals with ratios, a 7-day mean and the rank of the day.

    Both windows run over the totals: at most one row per region and date.
    """
    in_scope = ["region"] + (["business_date"] if options.scope == "run" else [])
    week = days_back(in_scope, "business_date", 7)
    of_day = Window.partitionBy("business_date").orderBy(F.col("kwh").desc_nulls_last())
    totals, earlier = daily_totals(frames["silver_enriched"]), frames.get("earlier_days")
    if options.scope == "history" and earlier is not None:
        totals = totals.withColumn("_own", F.lit(True)).unionByName(
            earlier.select("business_date", "region", "kwh", F.lit(False).alias("_own")), allowMissingColumns=True
        )
    daily = totals.select(
        "*",
        round_to(safe_divide(F.col("kwh"), F.col("meters")), 4).alias("kwh_per_meter"),
        round_to(safe_divide(100.0 * F.col("peak_kwh"), F.col("kwh")), 2).alias("peak_share_pct"),
        round_to(F.avg("kwh").over(week), 3).alias("kwh_7d_avg"),
        F.dense_rank().over(of_day).cast("long").alias("rank_in_day"),
    )
    return daily.filter("_own").drop("_own") if "_own" in daily.columns else daily


def hourly_load_profile(enriched: DataFrame) -> DataFrame:
    """Consumption per region and hour of day, and its share of the region's day."""
    hourly = enriched.groupBy("business_date", "region", F.hour("reading_ts").cast("long").alias("hour_of_day")).agg(
        F.sum("interval_kwh").alias("kwh"), round_to(F.avg("temp_c"), 2).alias("avg_temp_c")
    )
    # At most 24 rows per region and date reach the window.
    of_day = F.sum("kwh").over(Window.partitionBy("business_date", "region"))
    return hourly.withColumn("share_pct", round_to(safe_divide(100.0 * F.col("kwh"), of_day), 2))


def meter_totals(enriched: DataFrame) -> DataFrame:
    """One row per meter and date, consumption also per installed kW."""
    return (
        enriched.groupBy("meter_id", "region", "customer_segment", "business_date")
        .agg(
            F.any_value("capacity_kw", ignoreNulls=True).alias("capacity_kw"),
            round_to(F.sum("interval_kwh"), 3).alias("kwh"),
            round_to(F.sum("cost_eur"), 2).alias("cost_eur"),
            round_to(F.max("interval_kwh"), 3).alias("max_interval_kwh"),
            F.count(F.lit(1)).alias("intervals"),
        )
        .withColumn("kwh_per_kw", round_to(safe_divide(F.col("kwh"), F.col("capacity_kw")), 4))
    )


def gold_meter_anomalies(frames: Frames, options: Options) -> DataFrame:
    """Flagged meters and the top meters of each region.

    The totals per meter feed the group figures, the cut-offs and the rows
    themselves; they are far smaller than their input and computed once.
    """
    peers = ["region", "business_date"]
    scored = score_against_group(
        meter_totals(frames["silver_enriched"]), peers, "kwh_per_kw", top_n=TOP_METERS,
        mean="region_avg", deviation="region_sd",
    )
    return scored.filter((F.col("anomaly_band") != "normal") | F.col("is_leader")).select(
        "meter_id", "region", "customer_segment", "business_date", "capacity_kw", "kwh", "cost_eur",
        "max_interval_kwh", "intervals", "kwh_per_kw", "z_score", "anomaly_band",
        round_to(F.col("region_avg"), 4).alias("region_avg_kwh_per_kw"),
        round_to(F.col("region_sd"), 4).alias("region_sd_kwh_per_kw"),
    )


BUILD: Mapping[str, Callable[[Frames, Options], DataFrame]] = {
    "bronze_readings": bronze_readings,
    "bronze_meters": bronze_meters,
    "bronze_tariffs": bronze_tariffs,
    "bronze_weather": bronze_weather,
    "silver_cleanse": silver_cleanse,
    "silver_enrich": silver_enrich,
    "gold_daily_region": gold_daily_region,
    "gold_meter_anomalies": gold_meter_anomalies,
}
