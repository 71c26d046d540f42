import os
from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
from conftest import rows
from pyspark.sql import functions as F

from wattlake.operators.rejects import REASON, cast_or_reason
from wattlake.plans.catalog import PUBLISHED
from wattlake.plans.run import Engine
from wattlake.sources.footers import column_bytes, footers, unfit_files
from wattlake.sources.synthetic import seed_landing
from wattlake.streaming.event_time import append_closed, windowed_totals

T0 = datetime(2026, 8, 1)
EVENTS = "id long, at timestamp_ntz, k string, v long"


def _write(spark, path, events):
    spark.createDataFrame(events, EVENTS).coalesce(1).write.mode("append").parquet(path)


def test_windows_are_written_once_and_a_restart_goes_on(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    hour = lambda h: T0 + timedelta(hours=h)

    def run():
        stream = spark.readStream.schema(EVENTS).parquet(source)
        totals = {"n": F.count(F.lit(1)), "total": F.sum("v")}
        closed = windowed_totals(stream, "at", ["k"], totals, width="1 hour", delay="1 hour", unique=["id"])
        append_closed(closed, out, state).awaitTermination()
        return rows(spark.read.schema(closed.schema).parquet(out))

    _write(spark, source, [(1, hour(0.1), "a", 5), (1, hour(0.1), "a", 5), (2, hour(0.2), "a", 7), (3, hour(1.5), "b", 1)])
    assert run() == []  # the watermark is at half past, so no window has closed
    _write(spark, source, [(4, hour(0.6), "a", 1), (2, hour(0.2), "a", 7), (5, hour(4), None, 2)])
    expected = [(hour(0), hour(1), "a", 3, 13), (hour(1), hour(2), "b", 1, 1)]
    assert run() == expected
    _write(spark, source, [(6, hour(0.3), "a", 100)])  # later than the delay allows
    assert run() == expected
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        _write(spark, source, [(7, hour(9), "a", 3)])
        assert rows(spark.read.parquet(out)) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert run() == sorted([*expected, (hour(4), hour(5), None, 1, 2)], key=repr)


def test_values_that_cannot_be_cast_are_named(spark):
    raw = spark.createDataFrame([("1.5", "7", "x"), ("bad", None, "y"), (None, "8z", "z"), ("", "9", None)], "a string, b string, c string")
    got = {r.c: (r.a, r.b, list(r[REASON])) for r in cast_or_reason(raw, {"a": "double", "b": "int"}).collect()}
    assert got == {"x": (1.5, 7, []), "y": (None, None, ["a: bad"]), "z": (None, None, ["b: 8z"]), None: (None, 9, ["a: "])}
    assert "Exchange" not in cast_or_reason(raw, {"a": "double"})._jdf.queryExecution().executedPlan().toString()


def test_footers_are_what_the_files_say(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("v"), F.lit("x").alias("s"))
    frame.repartition(3).write.option("parquet.block.size", "4096").parquet(path)
    found = footers(spark, path).collect()
    own = {f: pq.ParquetFile(f"{path}/{f}").metadata for f in os.listdir(path) if f.endswith(".parquet")}
    assert {r.path.rsplit("/", 1)[1]: (r.rows, r.row_groups) for r in found} == {f: (m.num_rows, m.num_row_groups) for f, m in own.items()}
    sizes = {}
    for m in own.values():
        for g in range(m.num_row_groups):
            for c in range(m.num_columns):
                part = m.row_group(g).column(c)
                sizes[part.path_in_schema] = sizes.get(part.path_in_schema, 0) + part.total_compressed_size
    assert {r.name: (r.compressed, r.nulls) for r in column_bytes(footers(spark, path)).collect()} == {
        "id": (sizes["id"], 0), "v": (sizes["v"], 1667), "s": (sizes["s"], 0)
    }
    with open(f"{path}/part-broken.parquet", "wb") as broken:
        broken.write(b"PAR1 nothing")
    bad = {r.path.rsplit("/", 1)[1]: r.reason for r in unfit_files(spark, [path], "id bigint, v string, s string").collect()}
    assert len(bad) == len(own) + 1 and all("v is stored as INT64" in bad[f] for f in own) and "Error" in bad["part-broken.parquet"] or "Arrow" in bad["part-broken.parquet"]
    assert [r.path.rsplit("/", 1)[1] for r in unfit_files(spark, [path], "id bigint, v bigint").collect()] == ["part-broken.parquet"]


def test_bad_dates_are_named_by_one_job_and_the_others_go_on_together(spark, tmp_path, monkeypatch):
    days = [date(2026, 8, d) for d in range(1, 7)]
    lake = f"{tmp_path}/lake"
    seed_landing(spark, lake, days, 30)
    for day in (days[1], days[4]):
        folder = f"{lake}/landing/landing_readings/dt={day}"
        for name in os.listdir(folder):
            if name.endswith(".parquet"):
                with open(f"{folder}/{name}", "wb") as broken:
                    broken.write(b"PAR1 this is no footer PAR1")
                os.remove(f"{folder}/.{name}.crc")
    engine = Engine(spark, lake, f"{tmp_path}/warehouse")
    tried = []
    begin = Engine._begin
    monkeypatch.setattr(Engine, "_begin", lambda self, runs: tried.append(sorted(runs)) or begin(self, runs))
    done = engine.run_dates(days, "r-")
    good = [d for d in days if d not in (days[1], days[4])]
    assert tried == [days, good]  # once with all, once with the good ones
    assert sorted(done.completed) == good and sorted(done.failed) == [days[1], days[4]]
    assert "landing_readings" in done.runs[days[1]].error
    assert {r.business_date for r in engine.warehouse.table(PUBLISHED["gold_daily_region"]).collect()} == set(good)
    assert {r.business_date: r.status for r in engine.log.table("runs").filter("finished_at is not null").collect()}[days[4]] == "failed"
