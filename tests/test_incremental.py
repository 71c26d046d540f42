import random
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wattlake.operators.changes import changed_intervals, touched_dates
from wattlake.plans import medallion
from wattlake.plans.incremental import BUCKETS, MeterSums
from wattlake.plans.medallion import Options
from wattlake.plans.telemetry_queries import bronze

FOLDER = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def frames(spark):
    return {name: spark.createDataFrame(f.collect(), f.schema) for name, f in bronze(spark, FOLDER).items()}


def full(frames):
    given = dict(frames)
    given["silver_readings"] = medallion.accepted(medallion.classified_readings(given["bronze_readings"], Options()))
    enriched = {"silver_enriched": medallion.silver_enrich(given, Options())}
    return rows(medallion.gold_daily_region(enriched, Options())), rows(medallion.gold_meter_anomalies(enriched, Options()))


def figures(kept, frames):
    scores = kept.meter_scores()
    return rows(kept.daily_region()), rows(scores.select(*medallion_columns(frames)))


def medallion_columns(frames):
    return ("meter_id region customer_segment business_date capacity_kw kwh cost_eur max_interval_kwh intervals kwh_per_kw "
            "z_score anomaly_band region_avg_kwh_per_kw region_sd_kwh_per_kw").split()


def test_late_batches_and_changed_dimensions_equal_a_full_reprocess(spark, tmp_path, frames):
    readings, dims = frames["bronze_readings"], {k: v for k, v in frames.items() if k != "bronze_readings"}
    late = F.hour("reading_ts").between(6, 8) & F.col("meter_id").endswith("1")
    kept = MeterSums(spark, str(tmp_path / "sums"))
    kept.arrive(0, readings.filter(~late), dims)
    before = figures(kept, frames)
    kept.arrive(1, readings.filter(late), dims)
    assert figures(kept, frames) == full(frames) != before
    again = figures(kept, frames)
    kept.arrive(1, readings.filter(late), dims)  # delivered twice
    assert figures(kept, frames) == again

    half = F.hour("valid_from") % 2 == 0
    prices = dims["bronze_tariffs"].withColumn("price_per_kwh", F.when(half, F.col("price_per_kwh") * 2).otherwise(F.col("price_per_kwh")))
    warm = dims["bronze_weather"].withColumn("temp_c", F.when(F.col("region") == "asia", F.col("temp_c") + 8).otherwise(F.col("temp_c")))
    moved = dims["bronze_meters"].withColumn("region", F.when(F.col("meter_id").endswith("3"), "asia").otherwise(F.col("region")))
    for batch, (name, new) in enumerate({"bronze_tariffs": prices, "bronze_weather": warm, "bronze_meters": moved}.items()):
        old, dims = dims[name], dims | {name: new}
        kept.dimension_changed(10 + batch, name, old, dims)
        assert figures(kept, frames) == full(dims | {"bronze_readings": readings}), name


def test_readings_of_unchanged_meters_are_not_read(spark, tmp_path, frames):
    readings, dims = frames["bronze_readings"], {k: v for k, v in frames.items() if k != "bronze_readings"}
    kept = MeterSums(spark, str(tmp_path / "sums"))
    kept.arrive(0, readings, dims)
    pairs = readings.filter("meter_id = 'M7'").select("meter_id", "business_date").distinct()
    bucket = pairs.select(F.pmod(F.xxhash64("meter_id"), F.lit(BUCKETS)).cast("int")).first()[0]
    near = kept.readings_of(pairs, [bucket])
    assert rows(near.select("meter_id").distinct()) == [("M7",)]
    assert {f.split("bucket=")[1].split("/")[0] for f in near.inputFiles() if f"bucket={bucket}/" in f} == {str(bucket)}
    scan = [x for x in near._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x and "readings" in x]
    assert scan and all("PartitionFilters: [" in x and "bucket" in x.split("PartitionFilters: [")[1].split("]")[0] for x in scan)
    # A meter whose readings are all rejected has no figures any more.
    gone = readings.filter("meter_id = 'M7'").withColumns({"cumulative_kwh": F.lit(None).cast("double"), "src_updated_at": F.lit("2099-01-01").cast("timestamp_ntz")})
    kept.arrive(1, gone, dims)
    assert kept.sums().filter("meter_id = 'M7'").count() == 0 < kept.sums().count()


def test_no_batches(spark, tmp_path):
    kept = MeterSums(spark, str(tmp_path / "none"))
    assert kept.daily_region().collect() == [] and kept.sums().collect() == []


def in_force(snapshot, key, moment):
    hits = [(t, v) for k, t, v in snapshot if k == key and t is not None and t <= moment]
    return max(hits, key=lambda x: (x[0], x[1] is not None, x[1] or 0))[1:] if hits else None


@pytest.mark.parametrize("seed", range(3))
def test_changed_intervals_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    moment = lambda: rng.choice([None] + [T0 + timedelta(hours=6 * rng.randrange(40)) for _ in range(9)])
    old = [(rng.choice(["a", "b", None]), moment(), rng.choice([None, 1, 2])) for _ in range(40)]
    new = [x for x in old if rng.random() < 0.8] + [(rng.choice(["b", "c"]), moment(), rng.choice([1, 2])) for _ in range(6)]
    o, n = (spark.createDataFrame(x, "k string, at timestamp_ntz, v int") for x in (old, new))
    got = changed_intervals(o, n, ["k"], "at")
    found = got.collect()
    for key in ("a", "b", "c", None):
        for step in range(42):
            now = T0 + timedelta(hours=6 * step + 1)
            covered = any(r.k == key and r.since <= now and (r.until is None or now < r.until) for r in found)
            assert covered == (in_force(old, key, now) != in_force(new, key, now)), (key, now)
    days = {(r.k, r.touched) for r in touched_dates(got, date(2024, 1, 2), date(2024, 1, 5), "k").collect()}
    assert days == {
        (r.k, d) for r in found for d in (date(2024, 1, x) for x in (2, 3, 4, 5))
        if r.since < datetime(d.year, d.month, d.day) + timedelta(days=1) and (r.until is None or r.until > datetime(d.year, d.month, d.day))
    }


def test_changes_of_rows_without_time(spark):
    o, n = (spark.createDataFrame(x, "k string, v int") for x in ([("a", 1), ("b", None), ("c", 3)], [("a", 1), ("b", 2), ("d", None)]))
    assert rows(changed_intervals(o, n, ["k"])) == [("b", None, None), ("c", None, None), ("d", None, None)]
    assert changed_intervals(o.limit(0), n.limit(0), ["k"]).collect() == []


def test_dates_of_overlapping_intervals_come_once_and_are_not_grouped(spark):
    moment = lambda d, h=0: datetime(2024, 1, d, h)
    given = [("a", moment(2), moment(5)), ("a", moment(2), moment(3)), ("a", moment(4, 6), moment(6, 1)), ("a", moment(9), moment(9)),
             ("b", None, moment(3)), ("b", moment(7), None), (None, moment(1), moment(2, 1)), (None, moment(2), moment(2, 5)), ("c", moment(30), None)]
    intervals = spark.createDataFrame(given, "k string, since timestamp_ntz, until timestamp_ntz")
    touched = touched_dates(intervals, date(2024, 1, 1), date(2024, 1, 8), "k")
    expected = [("a", d) for d in (2, 3, 4, 5, 6)] + [("b", d) for d in (1, 2, 7, 8)] + [(None, d) for d in (1, 2)]
    assert sorted(((r.k or "", r.touched.day) for r in touched.collect())) == sorted((k or "", d) for k, d in expected)
    assert "Aggregate" not in touched._jdf.queryExecution().optimizedPlan().toString()
    days = [r.touched.day for r in touched_dates(intervals, date(2024, 1, 1), date(2024, 1, 8)).collect()]
    assert sorted(days) == list(range(1, 9))
