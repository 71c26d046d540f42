from datetime import date

from conftest import rows
from pyspark.sql import functions as F

from wattlake.plans.catalog import PUBLISHED
from wattlake.plans.run import Engine
from wattlake.sources.synthetic import readings, seed_landing
from wattlake.streaming import process_arrivals
from wattlake.streaming.arrivals import process_changed_dimension

DAYS = [date(2026, 8, 1), date(2026, 8, 2)]
METERS = 120


def test_late_readings_end_up_as_in_a_full_reprocess(spark, tmp_path):
    lake = f"{tmp_path}/lake"
    seed_landing(spark, lake, DAYS, METERS)
    target = f"{lake}/landing/landing_readings"
    everything = readings(spark, DAYS, METERS).withColumn("late", F.hour("ts").between(6, 8) & (F.col("dt") == F.lit(DAYS[0])))
    # On time: everything but three hours of the first date.
    everything.filter("NOT late").drop("late").write.mode("overwrite").partitionBy("dt").parquet(target)

    engine = Engine(spark, lake, f"{tmp_path}/warehouse")
    process_arrivals(engine, f"{tmp_path}/stream").awaitTermination()
    early = {t: rows(engine.warehouse.table(t)) for t in PUBLISHED.values()}

    everything.filter("late").drop("late").write.mode("append").partitionBy("dt").parquet(target)
    process_arrivals(engine, f"{tmp_path}/stream").awaitTermination()
    late = {t: rows(engine.warehouse.table(t)) for t in PUBLISHED.values()}

    full = Engine(spark, lake, f"{tmp_path}/full")
    full.run_dates(DAYS, "full-")
    assert late == {t: rows(full.warehouse.table(t)) for t in PUBLISHED.values()}
    assert late != early
    # Only the date with new files was run again.
    runs = {r.run_id for r in engine.log.table("runs").collect()}
    assert runs == {"arrivals-0-2026-08-01", "arrivals-0-2026-08-02", "arrivals-1-2026-08-01"}
    # Nothing new, nothing to do.
    process_arrivals(engine, f"{tmp_path}/stream").awaitTermination()
    assert engine.log.table("runs").count() == 3


def _rewrite(spark, rows, target, parts=()):
    """A dimension's files with other contents."""
    kept = rows.collect()
    frame = spark.createDataFrame(kept, rows.schema)
    if parts:
        frame.write.mode("overwrite").partitionBy(*parts).parquet(target)
    else:
        frame.withColumn("valid_from", F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss")).write.mode("overwrite").option("header", True).csv(target)
    return spark.createDataFrame(kept, rows.schema)


def test_a_corrected_price_or_observation_runs_exactly_its_dates_again(spark, tmp_path):
    days = [date(2026, 8, d) for d in (1, 2, 3)]
    lake = f"{tmp_path}/lake"
    seed_landing(spark, lake, days, METERS)
    engine = Engine(spark, lake, f"{tmp_path}/warehouse")
    engine.run_dates(days, "first-")

    old = spark.createDataFrame(engine.lake.landing("landing_tariffs", []).collect(), "tariff_plan string, valid_from timestamp_ntz, price_per_kwh double, currency string")
    at = F.lit("2026-08-02 23:00:00").cast("timestamp_ntz")
    price = F.when(F.col("valid_from") == at, 0.5).otherwise(F.col("price_per_kwh"))
    _rewrite(spark, old.withColumn("price_per_kwh", price), f"{lake}/landing/landing_tariffs")
    done = process_changed_dimension(engine, "landing_tariffs", old, prefix="price-")
    assert sorted(done.completed) == [days[1]] and not done.failed
    assert process_changed_dimension(engine, "landing_tariffs", engine.lake.landing("landing_tariffs", []), prefix="none-").completed == []

    weather = engine.lake.landing("landing_weather", days)
    old = spark.createDataFrame(weather.collect(), weather.schema)
    warmer = F.when(F.col("dt") == F.lit(days[2]), F.col("temp_c") + 1).otherwise(F.col("temp_c"))
    _rewrite(spark, old.withColumn("temp_c", warmer), f"{lake}/landing/landing_weather", ["dt"])
    assert process_changed_dimension(engine, "landing_weather", old, prefix="weather-").completed == [days[2]]

    full = Engine(spark, lake, f"{tmp_path}/full")
    full.run_dates(days, "full-")
    for t in PUBLISHED.values():
        assert rows(engine.warehouse.table(t)) == rows(full.warehouse.table(t))
