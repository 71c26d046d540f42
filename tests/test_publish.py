from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wattlake import reports
from wattlake.publish import Target, Warehouse
from wattlake.runlog import RunLog
from wattlake.sources import files
from wattlake.sources.lake import Lake, query, read_source, register_source

DAY = date(2026, 8, 1)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def write(spark, tmp_path, name, kwh, count=3, day=DAY):
    path = str(tmp_path / "gold" / f"dt={day}" / f"run={name}")
    spark.range(count).select(
        F.lit(day).alias("business_date"),
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("region"),
        (F.col("id") + kwh).alias("kwh"),
    ).coalesce(1).write.parquet(path)
    return path


def current(warehouse):
    return [r.kwh for r in warehouse.table("gold.t").orderBy("region").collect()]


def test_publish_is_idempotent(spark, tmp_path, warehouse):
    target = Target("gold.t", write(spark, tmp_path, "v1", 100.0), DAY)
    first, second = warehouse.publish("run-1", [target]), warehouse.publish("run-1", [target])
    assert first.total_rows == second.total_rows == 3
    assert len(current(warehouse)) == 3
    assert second.events[0].previous_run_id == ""
    assert (first.events[0].rows_deleted, second.events[0].rows_deleted) == (0, 3)
    assert warehouse.publish_log().count() == 1


def test_restore_returns_to_the_run_before(spark, tmp_path, warehouse):
    good, bad = write(spark, tmp_path, "good", 100.0), write(spark, tmp_path, "bad", 999.0)
    warehouse.publish("run-good", [Target("gold.t", good, DAY)])
    done = warehouse.publish("run-bad", [Target("gold.t", bad, DAY)])
    assert done.events[0].previous_run_id == "run-good"
    assert current(warehouse)[0] == 999.0
    result = warehouse.restore("run-bad", DAY, "quality gate failed")
    assert result.restored == ["gold.t@2026-08-01->run run-good"] and not result.deleted
    assert current(warehouse)[0] == 100.0
    log = {r.run_id: r.compensated for r in warehouse.publish_log().collect()}
    assert log == {"run-good": False, "run-bad": True}


def test_restore_of_a_first_publish_leaves_the_date_absent(spark, tmp_path, warehouse):
    warehouse.publish("run-1", [Target("gold.t", write(spark, tmp_path, "only", 42.0), DAY)])
    result = warehouse.restore("run-1", DAY, "boom")
    assert result.deleted == ["gold.t@2026-08-01"] and not result.restored
    assert current(warehouse) == []
    assert warehouse.table("gold.t").columns == ["business_date", "region", "kwh"]


def test_restore_is_idempotent(spark, tmp_path, warehouse):
    warehouse.publish("run-1", [Target("gold.t", write(spark, tmp_path, "only", 42.0), DAY)])
    warehouse.restore("run-1", DAY, "boom")
    again = warehouse.restore("run-1", DAY, "boom")
    assert "no publish of this run stands" in again.note and not again.deleted
    assert "no publish of this run stands" in warehouse.restore("run-x", DAY, "boom").note


def test_publishing_again_after_a_restore_counts_again(spark, tmp_path, warehouse):
    target = Target("gold.t", write(spark, tmp_path, "v1", 1.0), DAY)
    warehouse.publish("run-1", [target])
    warehouse.restore("run-1", DAY, "boom")
    warehouse.publish("run-1", [target])
    assert current(warehouse) == [1.0, 2.0, 3.0]
    assert not warehouse.publish_log().first().compensated


def test_an_undone_run_is_nobodys_predecessor(spark, tmp_path, warehouse):
    paths = [write(spark, tmp_path, f"v{i}", 10.0 * i) for i in range(3)]
    for i in (0, 1):
        warehouse.publish(f"run-{i}", [Target("gold.t", paths[i], DAY)])
    warehouse.restore("run-1", DAY, "boom")
    done = warehouse.publish("run-2", [Target("gold.t", paths[2], DAY)])
    assert done.events[0].previous_run_id == "run-0"


def test_restore_of_a_replaced_run_uses_its_own_predecessor(spark, tmp_path, warehouse):
    paths = [write(spark, tmp_path, f"v{i}", 10.0 * i) for i in range(3)]
    for i, path in enumerate(paths):
        warehouse.publish(f"run-{i}", [Target("gold.t", path, DAY)])
    warehouse.restore("run-1", DAY, "late")
    assert current(warehouse)[0] == 0.0


def test_other_dates_and_tables_are_left_alone_and_published_together(spark, tmp_path, warehouse):
    other = date(2026, 8, 2)
    a, b = write(spark, tmp_path, "a", 1.0), write(spark, tmp_path, "b", 5.0, count=2, day=other)
    warehouse.publish("r", [Target("gold.t", a, DAY), Target("gold.u", a, DAY), Target("gold.t", b, other)])
    assert warehouse.table("gold.t").count() == 5 and warehouse.table("gold.u").count() == 3
    warehouse.restore("r", other, "x")
    assert warehouse.table("gold.t").count() == 3
    assert warehouse.tables() == ["gold.t", "gold.u"]


def test_columns_by_name(spark, tmp_path, warehouse):
    warehouse.publish("r1", [Target("gold.t", write(spark, tmp_path, "a", 1.0), DAY)])
    day2, day3, day4 = (date(2026, 8, d) for d in (2, 3, 4))
    moved = str(tmp_path / "moved")
    spark.sql("SELECT 'r0' AS region, DATE '2026-08-02' AS business_date").coalesce(1).write.parquet(moved)
    warehouse.publish("r2", [Target("gold.t", moved, day2)])
    assert [r.kwh for r in warehouse.table("gold.t").filter("business_date = '2026-08-02'").collect()] == [None]
    extra = str(tmp_path / "extra")
    spark.sql("SELECT 'r0' AS region, DATE '2026-08-03' AS business_date, 1 AS surprise").write.parquet(extra)
    with pytest.raises(ValueError, match="surprise"):
        warehouse.publish("r3", [Target("gold.t", extra, day3)])
    with pytest.raises(ValueError, match="other dates"):
        warehouse.publish("r4", [Target("gold.t", write(spark, tmp_path, "b", 1.0), day4)])


def test_replaced_runs_are_not_read(spark, tmp_path, warehouse):
    for i in range(3):
        warehouse.publish(f"run-{i}", [Target("gold.t", write(spark, tmp_path, f"v{i}", float(i)), DAY)])
    (file,) = warehouse.table("gold.t").inputFiles()
    assert "run=v2" in file


def test_records_are_replaced_not_added(spark, tmp_path):
    log = RunLog(spark, str(tmp_path))
    run = {"run_id": "r1", "workflow_id": "w", "business_date": DAY, "mode": "auto", "status": "running",
           "started_at": datetime(2026, 8, 1)}
    step = {"run_id": "r1", "step_key": "bronze_readings", "layer": "bronze", "state": "succeeded"}
    log.append({"runs": [run], "step_metrics": [step | {"rows_out": 10}]})
    log.append({"runs": [run | {"status": "succeeded", "mode": "lean"}], "step_metrics": [step | {"rows_out": 20}]})
    (stored,) = log.table("runs").collect()
    assert (stored.status, stored.mode) == ("succeeded", "auto")
    assert [r.rows_out for r in log.table("step_metrics").collect()] == [20]
    counts = {r.table_name: r.rows for r in reports.row_counts(log.tables()).collect()}
    assert counts == {"runs": 1, "step_metrics": 1, "dq_results": 0, "lineage": 0}


def test_run_ids_stay_text_and_dates_prune(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    data = spark.createDataFrame(
        [("north", datetime(2026, 8, d), 1.0) for d in (1, 2)], "region string, observed_at timestamp_ntz, temp_c double"
    )
    dt = F.to_date("observed_at")
    lake.write("bronze", data, F.lit("bronze_weather"), dt, F.lit("007"), many_dates=True)
    history = lake.history("bronze_weather")
    assert {r.run for r in history.collect()} == {"007"}
    plan = history.filter(F.col("dt") == F.lit(DAY))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    one = lake.read("bronze_weather", {DAY: "007"})
    assert one.columns == ["region", "observed_at", "temp_c"] and one.count() == 1
    assert lake.read("bronze_weather", {date(2020, 1, 1): "007"}).count() == 0
    # The same run writing fewer dates again adds an attempt: nothing is replaced, and the newest is read.
    before = {r.file for r in lake.history("bronze_weather").select(F.input_file_name().alias("file")).collect()}
    assert lake.write("bronze", data.limit(1), F.lit("bronze_weather"), dt, F.lit("007"), many_dates=True).rows == 1
    after = {r.file for r in lake.history("bronze_weather").select(F.input_file_name().alias("file")).collect()}
    assert before < after and lake.history("bronze_weather").count() == 3
    assert lake.read("bronze_weather", {DAY: "007"}).count() == 1
    listed = files.inventory(spark, str(tmp_path)).collect()
    assert [(r.layer, r.dataset, r.runs) for r in listed] == [("bronze", "bronze_weather", 1)]


def test_sources(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    with open(path, "w") as f:
        f.write("b,a\n1,x\n2,\n")
    df = read_source(spark, path, "csv", "a string, b double")
    assert rows(df) == [("x", 1.0), (None, 2.0)]
    assert read_source(spark, path, "csv").schema["b"].dataType.typeName() == "integer"
    register_source(spark, "things", path, "csv")
    assert query(spark, "SELECT * FROM things ORDER BY b;", limit=1).count() == 1
    with pytest.raises(Exception, match="PARSE|syntax"):
        query(spark, "DROP VIEW things")
    with open(path, "w") as f:
        f.write("b,a\noops,x\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_source(spark, path, "csv", "a string, b double").collect()
