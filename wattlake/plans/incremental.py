"""Gold figures kept up to date from mergeable sums per meter and date.

Readings are stored by a bucket of their meter and, inside it, in the order of meters. For every meter and
date there is one row of sums: count, sum, sum of squares and greatest of the intervals, costs, peak
consumption, temperatures. When readings arrive, only the readings of the meters and dates that got some are
read again; their new sums are appended as a version, and the newest version counts. A changed price,
observation or meter does the same for the meters and dates that it was in force for. Region figures and
scores follow from the sums and never touch readings.

A batch has a number. Delivered again it writes the same version over, so a restart changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.functions import round_to, safe_divide
from wattlake.operators.changes import changed_intervals, touched_dates
from wattlake.operators.scoring import score_against_group
from wattlake.plans import medallion
from wattlake.plans.catalog import TOP_METERS
from wattlake.plans.medallion import Frames, Options
from wattlake.session import materialise
from wattlake.sources.files import children

BUCKETS = 64
KEYS = ["meter_id", "business_date"]
_READINGS = "meter_id string, reading_ts timestamp_ntz, cumulative_kwh double, voltage double, quality_flag string, src_updated_at timestamp_ntz, business_date date"
_SUMS = (
    "meter_id string, business_date date, region string, tariff_plan string, customer_segment string, capacity_kw double, intervals bigint, "
    "kwh double, kwh_squares double, max_kwh double, cost double, peak_kwh double, temp_sum double, temps bigint"
)


def meter_sums(enriched: DataFrame) -> DataFrame:
    """One row of mergeable sums for each meter and date of the enriched readings."""
    return enriched.groupBy(*KEYS).agg(
        *(F.any_value(c, ignoreNulls=True).alias(c) for c in ("region", "tariff_plan", "customer_segment", "capacity_kw")),
        F.count(F.lit(1)).alias("intervals"), F.sum("interval_kwh").alias("kwh"),
        F.sum(F.col("interval_kwh") * F.col("interval_kwh")).alias("kwh_squares"), F.max("interval_kwh").alias("max_kwh"),
        F.sum("cost_eur").alias("cost"), F.sum(F.when(F.col("is_peak"), F.col("interval_kwh"))).alias("peak_kwh"),
        F.sum("temp_c").alias("temp_sum"), F.count("temp_c").alias("temps"),
    )


class MeterSums:
    """Readings and sums below ``root``, for windows that stay within a date."""

    def __init__(self, spark: SparkSession, root: str, options: Options = Options()):
        self.spark, self.root, self.options = spark, root.rstrip("/"), options

    # -- changes -----------------------------------------------------------

    def arrive(self, batch: int, readings: DataFrame, dimensions: Frames) -> None:
        """Store new readings (columns of ``bronze_readings``) and renew the sums of their meters and dates."""
        stored = readings.withColumn("bucket", _bucket())
        (
            stored.repartition("bucket").sortWithinPartitions("bucket", "meter_id", "reading_ts")
            .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/readings/batch={batch:012d}")
        )
        own = self._readings().filter(F.col("batch") == batch)
        self._renew(batch, own.select(*KEYS).distinct(), dimensions)

    def dimension_changed(self, batch: int, name: str, old: DataFrame, dimensions: Frames) -> None:
        """Renew the sums of the meters and dates that a changed row of ``name`` was in force for.

        ``old`` is the snapshot the sums were made with, ``dimensions`` hold the new ones.
        """
        keys, time = {
            "bronze_tariffs": (["tariff_plan"], "valid_from"), "bronze_weather": (["region"], "observed_at"), "bronze_meters": (["meter_id"], None),
        }[name]
        daily = name == "bronze_weather" and "dt" in old.columns  # observations that hold on their own date only
        if daily:
            keys = [*keys, "dt"]
        changed = changed_intervals(old, dimensions[name], keys, time)
        known = self.sums()
        span = known.agg(F.min("business_date"), F.max("business_date")).first()
        if span[0] is None:
            return
        if time is None:  # a meter, on all its dates; also on those where it was not known before
            pairs = self._readings().select(*KEYS).distinct().join(changed.select(*keys).distinct(), keys, "left_semi")
        elif daily:
            days = changed.select("region", F.col("dt").alias("business_date")).distinct()
            pairs = known.join(days, ["region", "business_date"], "left_semi").select(*KEYS)
        else:
            days = touched_dates(changed, *span, *keys).withColumnRenamed("touched", "business_date")
            pairs = known.join(days, [*keys, "business_date"], "left_semi").select(*KEYS)
        self._renew(batch, pairs, dimensions)

    def _renew(self, batch: int, pairs: DataFrame, dimensions: Frames) -> None:
        pairs = materialise(pairs)
        buckets = [r.b for r in pairs.select(_bucket().alias("b")).distinct().collect()]  # at most BUCKETS
        readings = self.readings_of(pairs, buckets)
        frames = dict(dimensions) | {"silver_readings": medallion.accepted(medallion.classified_readings(readings, self.options))}
        found = meter_sums(medallion.silver_enrich(frames, self.options))
        # A meter of whose date nothing is accepted any more keeps a row that says so.
        whole = pairs.join(found, KEYS, "left").withColumn("intervals", F.coalesce("intervals", F.lit(0)))
        whole.write.mode("overwrite").parquet(f"{self.root}/sums/batch={batch:012d}")

    # -- what is there -----------------------------------------------------

    def _readings(self) -> DataFrame:
        return self.spark.read.schema(f"{_READINGS}, batch bigint, bucket int").parquet(f"{self.root}/readings")

    def readings_of(self, pairs: DataFrame, buckets: list[int]) -> DataFrame:
        """All readings of the meters and dates; only their buckets' files are opened."""
        near = self._readings().filter(F.col("bucket").isin(buckets))
        return near.join(pairs, KEYS, "left_semi").drop("batch", "bucket")

    def sums(self) -> DataFrame:
        """The newest sums of each meter and date with an accepted reading."""
        if not children(self.spark, f"{self.root}/sums"):
            return self.spark.createDataFrame([], _SUMS)
        every = self.spark.read.schema(f"{_SUMS}, batch bigint").parquet(f"{self.root}/sums")
        values = [c for c in every.columns if c not in (*KEYS, "batch")]
        newest = every.groupBy(*KEYS).agg(F.max_by(F.struct(*values), "batch").alias("_newest"))
        return newest.select(*KEYS, "_newest.*").filter("intervals > 0")

    def daily_region(self) -> DataFrame:
        """As ``gold_daily_region``, from the sums."""
        totals = self.sums().groupBy("business_date", "region").agg(
            F.count(F.lit(1)).alias("meters"), round_to(F.sum("kwh"), 3).alias("kwh"), round_to(F.sum("cost"), 2).alias("cost_eur"),
            round_to(F.sum("peak_kwh"), 3).alias("peak_kwh"),
            round_to(safe_divide(F.sum("temp_sum"), F.sum("temps")), 2).alias("avg_temp_c"),
        )
        of_day = Window.partitionBy("business_date").orderBy(F.col("kwh").desc_nulls_last())
        return totals.select(
            "*", round_to(safe_divide(F.col("kwh"), F.col("meters")), 4).alias("kwh_per_meter"),
            round_to(safe_divide(100.0 * F.col("peak_kwh"), F.col("kwh")), 2).alias("peak_share_pct"),
            round_to(F.col("kwh"), 3).alias("kwh_7d_avg"), F.dense_rank().over(of_day).cast("long").alias("rank_in_day"),
        )

    def meter_scores(self) -> DataFrame:
        """The figures of ``gold_meter_anomalies`` that are told of every flagged or leading meter, from the sums."""
        kwh = round_to(F.col("kwh"), 3)
        totals = self.sums().select(
            "meter_id", "region", "customer_segment", "business_date", "capacity_kw", kwh.alias("kwh"), round_to(F.col("cost"), 2).alias("cost_eur"),
            round_to(F.col("max_kwh"), 3).alias("max_interval_kwh"), "intervals",
            round_to(safe_divide(kwh, F.col("capacity_kw")), 4).alias("kwh_per_kw"),
        )
        scored = score_against_group(
            totals, ["region", "business_date"], "kwh_per_kw", top_n=TOP_METERS, mean="region_avg", deviation="region_sd"
        )
        return scored.filter((F.col("anomaly_band") != "normal") | F.col("is_leader")).drop("is_leader").withColumns({
            "region_avg_kwh_per_kw": round_to(F.col("region_avg"), 4), "region_sd_kwh_per_kw": round_to(F.col("region_sd"), 4),
        }).drop("region_avg", "region_sd")


def _bucket() -> Column:
    return F.pmod(F.xxhash64("meter_id"), F.lit(BUCKETS)).cast("int")

