import shutil
from dataclasses import replace
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wattlake import reports
from wattlake.plans.catalog import DATASETS, PHASES, PUBLISHED, STEPS
from wattlake.plans.medallion import BUILD, Options
from wattlake.plans.run import Engine, dates_between
from wattlake.quality import Expectation, QualityGateError
from wattlake.sources.lake import Lake
from wattlake.sources.synthetic import readings, seed_landing

DAY, NEXT = date(2026, 8, 1), date(2026, 8, 2)
METERS = 120
DAILY, ANOMALIES = PUBLISHED.values()


def engine_for(spark, root, days=(DAY,), scenario=""):
    seed_landing(spark, f"{root}/lake", list(days), METERS, scenario)
    return Engine(spark, f"{root}/lake", f"{root}/warehouse")


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    engine = engine_for(spark, tmp_path_factory.mktemp("clean"))
    return engine, engine.run_date(DAY, "first")


def test_catalog_holds_together():
    assert len(STEPS) == 8 and len(DATASETS) == 13
    assert sum(len(s.expectations) for s in STEPS.values()) == 27
    phased = [key for _, keys in PHASES for key in keys]
    assert sorted(phased) == sorted(STEPS) == sorted(BUILD)
    known = {d.name for d in DATASETS.values() if d.layer == "landing"}
    for _, keys in PHASES:
        for key in keys:
            assert set(STEPS[key].inputs) <= known, key
            assert all(e.dataset in DATASETS for e in STEPS[key].expectations)
        known |= {o for key in keys for o in STEPS[key].outputs}
    assert known == set(DATASETS) and set(PUBLISHED) <= known
    labels = [e.name for s in STEPS.values() for e in s.expectations]
    assert len(set(labels)) == len(labels)


def test_clean_day_publishes_both_tables(clean):
    engine, result = clean
    assert (result.status, result.steps_succeeded, result.steps_failed) == ("succeeded", 8, 0)
    assert set(result.published_tables) == {DAILY, ANOMALIES}
    daily = engine.warehouse.table(DAILY)
    assert daily.count() == 5
    assert result.rows_published == 5 + engine.warehouse.table(ANOMALIES).count()
    assert engine.log.table("runs").first().status == "succeeded"
    assert engine.log.table("step_metrics").count() == 8


def test_columns_are_those_of_the_catalog(clean, spark):
    engine, _ = clean
    for name, dataset in DATASETS.items():
        if dataset.layer != "landing":
            assert engine.lake.read(name, {DAY: "first"}).count() > 0, name
    for dataset, table in PUBLISHED.items():
        expected = spark.createDataFrame([], DATASETS[dataset].schema).dtypes
        assert engine.warehouse.table(table).dtypes == expected


def test_checks_and_lineage_are_recorded_under_their_step(clean):
    engine, _ = clean
    recorded = {(r.step_key, r.check_name) for r in engine.log.table("dq_results").collect()}
    assert recorded == {(k, e.name) for k, s in STEPS.items() for e in s.expectations}
    assert all(r.passed for r in engine.log.table("dq_results").collect())
    edges = {(r.step_key, r.upstream, r.downstream) for r in engine.log.table("lineage").collect()}
    assert edges == {(k, up, down) for k, s in STEPS.items() for up, down in s.lineage()}


def test_rows_are_conserved(clean):
    engine, _ = clean
    runs = {DAY: "first"}
    raw = engine.lake.read("bronze_readings", runs)
    accepted, rejected = engine.lake.read("silver_readings", runs), engine.lake.read("silver_quarantine", runs)
    assert accepted.count() + rejected.count() == raw.select("meter_id", "reading_ts").distinct().count()
    assert raw.count() > METERS * 96
    assert accepted.count() + rejected.count() == METERS * 96
    reasons = {r.reject_reason for r in rejected.select("reject_reason").distinct().collect()}
    assert reasons == {
        "null_reading", "no_prior_reading", "meter_rollback", "implausible_spike", "voltage_out_of_range"
    }
    metrics = {r.step_key: r for r in engine.log.table("step_metrics").collect()}
    cleanse = metrics["silver_cleanse"]
    assert (cleanse.rows_in, cleanse.rows_out, cleanse.rows_rejected) == (
        raw.count(), accepted.count(), rejected.count()
    )
    assert metrics["silver_enrich"].rows_in == accepted.count() + METERS + 75 + 120
    assert all(m.bytes_out > 0 for m in metrics.values())


def test_stale_copies_lose(clean):
    engine, _ = clean
    runs = {DAY: "first"}
    raw = engine.lake.read("bronze_readings", runs).groupBy("meter_id", "reading_ts").agg(
        F.max("src_updated_at").alias("newest")
    )
    kept = engine.lake.read("silver_readings", runs).join(raw, ["meter_id", "reading_ts"])
    assert kept.filter("src_updated_at <> newest").count() == 0


def test_second_run_replaces_and_gives_the_same_numbers(clean):
    engine, first = clean
    before = {t: rows(engine.warehouse.table(t)) for t in PUBLISHED.values()}
    second = engine.run_date(DAY, "second")
    assert second.rows_published == first.rows_published
    assert {t: rows(engine.warehouse.table(t)) for t in PUBLISHED.values()} == before
    log = {(r.run_id, r.table_name): r.previous_run_id for r in engine.warehouse.publish_log().collect()}
    assert log["second", DAILY] == "first"


def test_failure_after_publishing_takes_it_back(clean):
    engine, _ = clean
    before = rows(engine.warehouse.table(DAILY))

    def fail():
        assert engine.warehouse.publish_log().filter("run_id = 'late'").count() == 2
        raise RuntimeError("injected failure")

    with pytest.raises(RuntimeError, match="injected"):
        engine.run_date(DAY, "late", after_publish=fail)
    assert rows(engine.warehouse.table(DAILY)) == before
    run = engine.log.table("runs").filter("run_id = 'late'").first()
    assert run.status == "compensated" and "injected failure" in run.error
    assert {r.compensated for r in engine.warehouse.publish_log().filter("run_id = 'late'").collect()} == {True}


def test_reports_of_a_run(clean):
    engine, _ = clean
    log = engine.log.tables()
    newest = reports.runs(log["runs"], DAY).first()
    assert newest.secs is not None
    assert reports.latest_step_metrics(log["step_metrics"], log["runs"]).count() == 8
    assert reports.latest_failed_checks(log["dq_results"], log["runs"]).count() == 0
    assert reports.latest_lineage(log["lineage"], log["runs"]).count() == 4 + 2 + 4 + 2
    assert reports.publishes(engine.warehouse.publish_log(), DAY).count() >= 2
    assert reports.steps_of_run(log["step_metrics"], "first").count() == 8
    assert reports.daily_by_region(engine.warehouse.table(DAILY)).first().rank_in_day == 1
    rollup = reports.run_rollup(log["step_metrics"], log["runs"]).filter("run_id = 'first'").first()
    assert (rollup.steps_succeeded, rollup.steps_failed) == (8, 0)


def test_negative_price_stops_the_run(spark, tmp_path):
    engine = engine_for(spark, tmp_path, scenario="bad_tariff")
    with pytest.raises(QualityGateError, match="quality gate failed.*tariff_price_sane"):
        engine.run_date(DAY, "bad")
    assert engine.warehouse.tables() == []
    assert engine.log.table("runs").first().status == "compensated"
    failed = engine.log.table("dq_results").filter("NOT passed").collect()
    assert [r.check_name for r in failed] == ["tariff_price_sane"]
    assert engine.log.table("lineage").filter("step_key = 'bronze_tariffs'").count() == 0
    assert engine.log.table("step_metrics").count() == 4


def test_a_warning_does_not_stop_the_run(spark, tmp_path):
    engine = engine_for(spark, tmp_path, scenario="voltage_storm")
    assert engine.run_date(DAY, "storm").status == "succeeded"
    failed = engine.log.table("dq_results").filter("NOT passed").collect()
    assert [(r.check_name, r.severity) for r in failed] == [("quarantine_rate", "warn")]


def test_missing_meters_are_noticed(spark, tmp_path):
    engine = engine_for(spark, tmp_path, scenario="missing_meters")
    with pytest.raises(QualityGateError, match="enrich_preserves_volume"):
        engine.run_date(DAY, "missing")
    assert engine.warehouse.tables() == []


def test_backfill_equals_single_runs(spark, tmp_path):
    days = dates_between(DAY, date(2026, 8, 3))
    engine = engine_for(spark, tmp_path, days)
    done = engine.backfill(days[0], days[-1])
    assert (done.completed, done.failed) == (days, [])
    together = {t: rows(engine.warehouse.table(t)) for t in PUBLISHED.values()}
    assert done.rows_published == sum(map(len, together.values()))
    alone = Engine(spark, f"{tmp_path}/lake", f"{tmp_path}/other")
    for day in days:
        alone.run_date(day, f"alone-{day}")
    assert {t: rows(alone.warehouse.table(t)) for t in PUBLISHED.values()} == together
    for m in alone.log.table("step_metrics").collect():
        day = m.run_id.removeprefix("alone-")
        other = engine.log.table("step_metrics").filter(
            (F.col("run_id") == f"backfill-{day}") & (F.col("step_key") == m.step_key)
        ).first()
        assert (m.rows_in, m.rows_out, m.rows_rejected) == (other.rows_in, other.rows_out, other.rows_rejected)
    # Nothing is left to do for dates named as completed.
    again = engine.backfill(days[0], days[-1], completed=days)
    assert again.runs == {} and again.completed == days


def test_raw_rows_are_gathered_by_date_only_if_their_files_are_many(spark, tmp_path, monkeypatch):
    days, gathered = [DAY, NEXT], {}
    engine = engine_for(spark, tmp_path, days)
    landed = engine.lake.dataset_path(DATASETS["landing_readings"])
    write = Lake.write

    def noted(self, layer, placed, dataset, dt, run, many_dates):
        gathered[dataset if isinstance(dataset, str) else layer] = many_dates
        return write(self, layer, placed, dataset, dt, run, many_dates)

    monkeypatch.setattr(Lake, "write", noted)
    engine.backfill(*days, prefix="few-")
    few, found = dict(gathered), rows(engine.warehouse.table(DAILY))
    assert not few["bronze_readings"] and not few["bronze_weather"]
    assert few["silver"] and few["silver_enriched"] and few["gold_daily_region"]
    for day in days:
        part = f"{landed}/dt={day}"
        held = spark.read.parquet(part).repartition(9, "meter_id")
        held.write.parquet(f"{tmp_path}/{day}")
        shutil.rmtree(part)
        shutil.move(f"{tmp_path}/{day}", part)
    engine.backfill(*days, prefix="many-")
    assert gathered["bronze_readings"] and not gathered["bronze_weather"]
    assert rows(engine.warehouse.table(DAILY)) == found


def test_backfill_goes_on_without_a_bad_date(spark, tmp_path):
    engine = engine_for(spark, tmp_path, (DAY, NEXT))
    # A date whose landing files are missing fails its gates.
    done = engine.backfill(DAY, date(2026, 8, 3))
    assert (done.completed, done.failed) == ([DAY, NEXT], [date(2026, 8, 3)])
    assert {r.business_date for r in engine.warehouse.table(DAILY).collect()} == {DAY, NEXT}
    status = {r.run_id: r.status for r in engine.log.table("runs").collect()}
    assert status == {"backfill-2026-08-01": "succeeded", "backfill-2026-08-02": "succeeded",
                      "backfill-2026-08-03": "failed"}


def test_dates_between():
    assert dates_between(DAY, NEXT) == [DAY, NEXT]
    with pytest.raises(ValueError, match="before start"):
        dates_between(NEXT, DAY)


def test_synthetic_rows_are_reproducible(spark):
    a, b = readings(spark, [DAY], 20), readings(spark, [DAY, NEXT], 20).repartition(5)
    assert rows(a) == rows(b.filter(F.col("dt") == F.lit(DAY)))
    with pytest.raises(ValueError, match="unknown scenario"):
        seed_landing(spark, "/nowhere", [DAY], 1, "flood")


def _with_gold_check(engine, **params):
    gold = STEPS["gold_daily_region"]
    failing = Expectation("row_count_min", "gold_daily_region", params={"min": 99}, name="impossible")
    steps = dict(STEPS) | {"gold_daily_region": replace(gold, expectations=(*gold.expectations, failing))}
    return Engine(engine.spark, engine.lake.root, engine.warehouse.root, steps=steps)


def test_a_failed_gate_leaves_what_is_published(spark, tmp_path):
    engine = engine_for(spark, tmp_path)
    engine.backfill(DAY, DAY)
    before = {t: rows(engine.warehouse.table(t)) for t in PUBLISHED.values()}
    halved = readings(spark, [DAY], METERS // 2)
    halved.write.mode("overwrite").partitionBy("dt").parquet(f"{tmp_path}/lake/landing/landing_readings")
    done = _with_gold_check(engine).backfill(DAY, DAY)
    assert (done.completed, done.failed) == ([], [DAY])
    assert {t: rows(engine.warehouse.table(t)) for t in PUBLISHED.values()} == before
    # The same run id again, now passing, replaces it; taking that back gives the files of before.
    again = engine.backfill(DAY, DAY)
    assert again.completed == [DAY]
    assert {t: rows(engine.warehouse.table(t)) for t in PUBLISHED.values()} != before


def test_an_emptied_date_fails_and_stays_published(spark, tmp_path):
    engine = engine_for(spark, tmp_path, (DAY, NEXT))
    engine.backfill(DAY, NEXT)
    before = {t: rows(engine.warehouse.table(t)) for t in PUBLISHED.values()}
    shutil.rmtree(f"{tmp_path}/lake/landing/landing_readings/dt={NEXT}")
    done = engine.backfill(DAY, NEXT)
    assert (done.completed, done.failed) == ([DAY], [NEXT])
    assert "no files" in done.runs[NEXT].error
    assert {t: rows(engine.warehouse.table(t)) for t in PUBLISHED.values()} == before


def test_a_date_without_weather_fails(spark, tmp_path):
    engine = engine_for(spark, tmp_path, (DAY, NEXT))
    shutil.rmtree(f"{tmp_path}/lake/landing/landing_weather/dt={DAY}")
    done = engine.backfill(DAY, NEXT)
    assert (done.completed, done.failed) == ([NEXT], [DAY])
    assert "landing_weather" in done.runs[DAY].error


@pytest.mark.parametrize("fault", ["file", "value"])
def test_a_date_that_breaks_a_job_does_not_stop_the_others(spark, tmp_path, fault):
    days = dates_between(DAY, date(2026, 8, 3))
    engine = engine_for(spark, tmp_path, days)
    folder = f"{tmp_path}/lake/landing/landing_readings/dt={NEXT}"
    if fault == "file":
        with open(f"{folder}/broken.parquet", "wb") as f:
            f.write(b"PAR1 this is no Parquet file PAR1")
    else:
        odd = spark.createDataFrame([("M1", "not a number")], "meter_id string, cumulative_kwh string")
        odd.write.mode("append").parquet(folder)
    done = engine.backfill(days[0], days[-1])
    assert (done.completed, done.failed) == ([DAY, date(2026, 8, 3)], [NEXT])
    assert {r.business_date for r in engine.warehouse.table(DAILY).collect()} == {DAY, date(2026, 8, 3)}
    status = {r.run_id: r.status for r in engine.log.table("runs").collect()}
    assert status == {f"backfill-{d}": "failed" if d == NEXT else "succeeded" for d in days}


def test_single_dates_of_the_history_scope_equal_one_backfill(spark, tmp_path):
    days = dates_between(DAY, date(2026, 8, 3))
    seed_landing(spark, f"{tmp_path}/lake", days, METERS)
    options = Options(scope="history")
    together = Engine(spark, f"{tmp_path}/lake", f"{tmp_path}/a", options)
    assert together.backfill(days[0], days[-1]).completed == days
    alone = Engine(spark, f"{tmp_path}/lake", f"{tmp_path}/b", options)
    for day in days:
        alone.run_date(day, f"alone-{day}")
    for table in PUBLISHED.values():
        assert rows(alone.warehouse.table(table)) == rows(together.warehouse.table(table))
    week = {(r.business_date, r.region): (r.kwh, r.kwh_7d_avg) for r in together.warehouse.table(DAILY).collect()}
    for (day, region), (_, mean) in week.items():
        own = [week[d, region][0] for d in days if d <= day]
        assert mean == pytest.approx(sum(own) / len(own), abs=1e-3)
    # Only the first day of all has first readings without a predecessor.
    lost = together.lake.history("silver_quarantine").filter("reject_reason = 'no_prior_reading' and run like 'backfill%'")
    firsts = {r.business_date: r["count"] for r in lost.groupBy("business_date").count().collect()}
    assert firsts[DAY] > METERS / 2 and all(n < METERS / 2 for d, n in firsts.items() if d != DAY)
    assert alone.touched([DAY]) == days and engine_for(spark, tmp_path / "x").touched([DAY]) == [DAY]
