"""A landing zone to try things on, with known defects in it.

Everything is an expression over a range of meters and quarter hours, hashed by
position: the same arguments give the same rows whatever the partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.plans.catalog import REGIONS, TARIFF_PLANS

SCENARIOS = ("", "bad_tariff", "missing_meters", "voltage_storm")

_SLOTS = 96

# Shares of rows that carry a defect.
_NULL, _SPIKE, _ROLLBACK, _BAD_VOLTAGE, _STALE_COPY, _STORM = 0.002, 0.001, 0.001, 0.0046, 0.015, 0.15


def _chance(salt: str, *columns: str) -> Column:
    """A number in [0, 1) that depends only on the columns and the salt."""
    return F.pmod(F.xxhash64(F.lit(salt), *columns), F.lit(1_000_003)) / 1_000_003


def _pick(values: Sequence[str], chance: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), F.floor(chance * len(values)).cast("int") + 1)


def _meters(spark: SparkSession, count: int) -> DataFrame:
    segment = F.when(_chance("segment", "id") < 0.85, "Residential").otherwise("Commercial")
    small, large = 3 + F.floor(_chance("kw", "id") * 6), 15 + F.floor(_chance("kw", "id") * 13)
    return spark.range(count).select(
        "id",
        F.format_string("M%07d", "id").alias("meter_id"),
        F.initcap(_pick(REGIONS, _chance("region", "id"))).alias("region"),
        F.upper(_pick(TARIFF_PLANS, _chance("plan", "id"))).alias("tariff_plan"),
        F.date_add(F.lit("2015-01-01").cast("date"), F.floor(_chance("age", "id") * 3000).cast("int")).alias("install_date"),
        F.when(segment == "Residential", small).otherwise(large).cast("double").alias("capacity_kw"),
        segment.alias("customer_segment"),
    )


def readings(spark: SparkSession, days: Sequence[date], meters: int, scenario: str = "") -> DataFrame:
    """Quarter-hour counters of every meter and date, with stale copies and defects.

    The counter is a closed form of meter and time, so it runs on across dates
    and no ordering of the rows is needed to produce it.
    """
    slot = F.col("slot")
    # Slot number with a daily rhythm, never decreasing, plus noise below its smallest step.
    rhythm = slot - 0.6 * _SLOTS / (2 * math.pi) * F.sin(2 * math.pi * slot / _SLOTS)
    noise = 0.3 * _chance("noise", "id", "dt", "slot")
    days_on = F.datediff("dt", F.lit("2026-01-01").cast("date"))
    rate = F.col("capacity_kw") / 50 * (0.6 + 0.8 * _chance("rate", "id")) * F.when(
        _chance("heavy", "id") < 0.005, 4
    ).otherwise(1)
    counter = 1000 + rate * (_SLOTS * (days_on + 400) + rhythm + noise)
    defect = _chance("defect", "id", "dt", "slot")
    edges = [_NULL, _NULL + _SPIKE, _NULL + _SPIKE + _ROLLBACK]
    volts = 225 + 20 * _chance("volts", "id", "dt", "slot")
    bad = _STORM if scenario == "voltage_storm" else _BAD_VOLTAGE
    base = (
        _meters(spark, meters)
        .withColumn("dt", F.explode(F.array(*map(F.lit, days))))
        .withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(_SLOTS - 1))))
        .select(
            "id", "slot", "dt", "meter_id",
            (F.col("dt").cast("timestamp_ntz") + F.make_dt_interval(mins=slot * 15)).alias("ts"),
            F.when(defect < edges[0], None)
            .when(defect < edges[1], counter + 500)
            .when(defect < edges[2], counter - 200)
            .otherwise(counter).alias("cumulative_kwh"),
            F.when(_chance("bad", "id", "dt", "slot") < bad, volts + 60).otherwise(volts).alias("voltage"),
            F.when(defect < edges[2], "suspect").otherwise("ok").alias("quality_flag"),
        )
    )
    rows = base.withColumn("src_updated_at", F.col("ts") + F.make_dt_interval(mins=F.lit(5)))
    # The earlier version of some rows: two per cent low and older.
    stale = (
        rows.filter(_chance("stale", "id", "dt", "slot") < _STALE_COPY)
        .withColumn("cumulative_kwh", F.col("cumulative_kwh") * 0.98)
        .withColumn("src_updated_at", F.col("ts"))
    )
    return rows.unionByName(stale).select(
        "meter_id", "ts", F.round("cumulative_kwh", 3).alias("cumulative_kwh"),
        F.round("voltage", 1).alias("voltage"), "quality_flag", "src_updated_at", "dt",
    )


def seed_landing(
    spark: SparkSession, root: str, days: Sequence[date], meters: int, scenario: str = ""
) -> None:
    """Write the landing files of these dates; existing ones are replaced.

    ``bad_tariff`` makes one price negative, ``missing_meters`` leaves a tenth of
    the meters out of the dimension, ``voltage_storm`` spoils many voltages.
    """
    if scenario not in SCENARIOS:
        raise ValueError(f"unknown scenario {scenario!r}")
    landing = f"{root.rstrip('/')}/landing"
    dated = {"partitionOverwriteMode": "dynamic", "compression": "zstd"}
    raw = readings(spark, days, meters, scenario)
    if len(days) > 1:
        raw = raw.hint("rebalance", "dt")
    raw.write.mode("overwrite").options(**dated).partitionBy("dt").parquet(f"{landing}/landing_readings")

    hours = spark.range(24).select(
        F.explode(F.array(*map(F.lit, days))).alias("dt"), F.col("id").cast("int").alias("hour")
    )
    weather = hours.select(
        "dt", "hour", F.explode(F.array(*map(F.lit, REGIONS))).alias("region")
    ).select(
        F.initcap("region").alias("region"),
        (F.col("dt").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("hour"))).alias("ts"),
        F.round(15 + 8 * F.sin((F.col("hour") - 6) * math.pi / 12) + 4 * _chance("temp", "region", "dt", "hour"), 1)
        .alias("temp_c"),
        "dt",
    )
    # A few rows a day, one file per date.
    weather.repartition("dt").write.mode("overwrite").options(**dated).partitionBy("dt").parquet(
        f"{landing}/landing_weather"
    )

    listed = _meters(spark, meters)
    if scenario == "missing_meters":
        listed = listed.filter(_chance("missing", "id") >= 0.1)
    listed.drop("id").write.mode("overwrite").option("header", True).csv(f"{landing}/landing_meters")

    plans = F.explode(F.array(*map(F.lit, TARIFF_PLANS))).alias("tariff_plan")
    start = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("valid_from")
    hourly = hours.select(
        plans, (F.col("dt").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("hour"))).alias("valid_from")
    )
    price = 0.15 + 0.25 * _chance("price", "tariff_plan", "valid_from")
    if scenario == "bad_tariff":
        price = F.when(
            (F.col("tariff_plan") == "tou") & (F.col("valid_from") == F.lit(days[0]).cast("timestamp_ntz")), -0.1
        ).otherwise(price)
    (
        spark.range(1).select(plans, start).unionByName(hourly)
        .select(
            F.upper("tariff_plan").alias("tariff_plan"),
            F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss").alias("valid_from"),
            F.round(price, 4).alias("price_per_kwh"), F.lit("eur").alias("currency"),
        )
        .coalesce(1).write.mode("overwrite").option("header", True).csv(f"{landing}/landing_tariffs")
    )
