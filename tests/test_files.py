import os
from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from wattlake.operators.sketches import estimates, sketch
from wattlake.publish import Target, Warehouse
from wattlake.quality import Expectation, evaluate
from wattlake.sources import files
from wattlake.sources.footers import column_ranges, footers, footprint
from wattlake.sources.lake import Lake
from wattlake.sources.layout import write_clustered
from wattlake.sources.tables import ensure_table, replace_date
from wattlake.written_checks import evaluate_files

DAY = date(2026, 8, 1)


def test_footprint_of_every_path_in_one_pass(spark, tmp_path):
    a, b, gone = (str(tmp_path / x) for x in ("a", "b", "gone"))
    spark.range(10).repartition(2).write.parquet(a)
    spark.range(5).coalesce(1).write.parquet(f"{b}/deep/er")
    with open(f"{b}/bad.parquet", "wb") as f:
        f.write(b"no parquet")
    size = lambda p: sum(os.path.getsize(os.path.join(d, n)) for d, _, ns in os.walk(p) for n in ns if n.endswith(".parquet"))
    expected = [(a, 2, 10, size(a)), (b, 2, 5, size(b)), (f"{b}/deep", 1, 5, size(f"{b}/deep")), (gone, 0, 0, 0)]
    assert rows(footprint(spark, [a, b, f"{b}/deep", gone])) == expected
    assert rows(footprint(spark, [gone])) == [(gone, 0, 0, 0)]


def test_ranges_are_told_only_where_every_footer_does(spark, tmp_path):
    path = str(tmp_path / "t")
    kinds = "i int, d date, t timestamp_ntz, s string, x double"
    at = datetime(2026, 8, 1, 12)
    spark.createDataFrame([(9, DAY, at, "a", 1.0), (None, None, None, None, None)], kinds).coalesce(1).write.parquet(path)
    spark.createDataFrame([(None, None, None, "b", float("nan"))], kinds).coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([(100, DAY + timedelta(1))], "i int, d date").coalesce(1).write.mode("append").parquet(path)
    told = column_ranges(footers(spark, path), dict(c.split() for c in kinds.split(", "))).first()
    assert (told["_rows"], told["_unread"]) == (4, 0)
    assert tuple(told["i"]) == (2, 9, 100, True) and tuple(told["d"]) == (2, DAY, DAY + timedelta(1), True)
    assert tuple(told["t"]) == (3, at, at, True) and tuple(told["x"])[:3] == (2, None, None) and tuple(told["s"])[:3] == (2, None, None)
    assert not told["x"]["told"] and not told["s"]["told"]


def test_checks_by_footers_equal_those_by_rows(spark, tmp_path):
    path, kinds = str(tmp_path / "t"), "i int, x double, n int"
    spark.createDataFrame([(1, 0.5, None), (7, 9.0, None), (None, float("nan"), None)], kinds).write.parquet(path)
    wanted = [
        Expectation("row_count_min", "t", params={"min": 3}), Expectation("row_count_max", "t", params={"max": 2}),
        Expectation("not_null", "t", "i"), Expectation("not_null", "t", "x"), Expectation("between", "t", "i", {"min": 1, "max": 7}),
        Expectation("between", "t", "i", {"min": 2, "max": 7}, name="out"), Expectation("between", "t", "x", {"min": 0, "max": 10}),
        Expectation("between", "t", "n", {"min": 0, "max": 1}), Expectation("unique", "t", "i", {"columns": ["i"]}),
        Expectation("not_null", "t", "none"), Expectation("not_null", "other", "i"), Expectation("strange", "t", "i", name="strange"),
    ]
    by_rows = evaluate(wanted, {"t": spark.read.schema(kinds).parquet(path)})
    assert evaluate_files(spark, wanted, {"t": path}, {"t": kinds}) == by_rows


def test_checks_that_footers_answer_read_no_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(50).write.parquet(path)
    monkeypatch.setattr("wattlake.written_checks.evaluate", None)
    wanted = [Expectation("row_count_min", "t", params={"min": 50}), Expectation("not_null", "t", "id"), Expectation("between", "t", "id", {"min": 0, "max": 49})]
    assert all(c.passed for c in evaluate_files(spark, wanted, {"t": path}, {"t": "id bigint"}))


def test_sketches_merge_to_what_one_pass_tells(spark):
    df = spark.range(40_000).select(
        (F.col("id") % 10).alias("day"), F.when(F.col("id") % 5 > 0, F.col("id") % 3000).alias("u"), F.col("id").cast("double").alias("v"), F.lit(None).cast("double").alias("w")
    )
    kept = sketch(df, ["day"], distinct=["u", "w"], quantiles=["v", "w"])
    found = {r.column: r for r in estimates(kept.filter("day < 5").withColumn("all", F.lit(1)), ["all"], (0.1, 0.9)).collect()}
    users = df.filter("day < 5").agg(F.count_distinct("u")).first()[0]
    assert abs(found["u"].distinct - users) <= 0.04 * users and found["u"].quantiles is None
    assert (found["v"].rows, found["v"].values, found["w"].rows, found["w"].values) == (20_000, 20_000, 20_000, 0)
    assert abs(found["v"].quantiles[0] - 4_000) < 800 and abs(found["v"].quantiles[1] - 36_000) < 800
    assert found["w"].distinct is None and found["w"].quantiles is None
    assert estimates(sketch(df.limit(0), ["day"], ["u"], ["v"]), ["day"]).collect() == []


def test_a_lookup_reads_few_row_groups(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.range(200_000).select(F.lit(DAY).alias("dt"), F.concat(F.lit("M"), F.pmod(F.xxhash64("id"), F.lit(500))).alias("meter"), F.col("id").alias("v"))
    write_clustered(df, path, "dt", "meter", bloom=["meter"], files_a_date=2, group_rows=5_000)
    metas = [pq.ParquetFile(os.path.join(d, n)).metadata for d, _, ns in os.walk(path) for n in ns if n.endswith(".parquet")]
    groups = [m.row_group(g).column(m.schema.names.index("meter")).statistics for m in metas for g in range(m.num_row_groups)]
    assert len(metas) <= 2 and len(groups) >= 40
    assert sum(s.min <= "M77" <= s.max for s in groups) <= 2
    read = spark.read.parquet(path).filter("meter = 'M77'")
    assert rows(read.select("v")) == rows(df.filter("meter = 'M77'").select("v"))


def test_a_date_of_a_catalog_table_is_replaced_by_name(spark, tmp_path):
    name = f"t_{os.path.basename(tmp_path)}".replace("-", "_")
    for _ in range(2):
        ensure_table(spark, name, "k bigint, s string, dt date", "dt", str(tmp_path / "t"))
    later = DAY + timedelta(days=1)
    replace_date(spark.createDataFrame([("a", 1, DAY)], "s string, k int, dt date"), name, "dt", DAY)
    replace_date(spark.createDataFrame([(2,)], "k bigint"), name, "dt", later)
    assert rows(spark.table(name)) == [(1, "a", DAY), (2, None, later)]
    with pytest.raises(ValueError, match="no column x"):
        replace_date(spark.createDataFrame([(1, 2)], "k bigint, x int"), name, "dt", DAY)
    for strange in (later, None):
        with pytest.raises(Exception, match="a row is of"):
            replace_date(spark.createDataFrame([(5, strange)], "k bigint, dt date"), name, "dt", DAY)
    assert rows(spark.table(name)) == [(1, "a", DAY), (2, None, later)]
    replace_date(spark.createDataFrame([(3,), (4,)], "k bigint"), name, "dt", DAY)
    replace_date(spark.createDataFrame([], "k bigint"), name, "dt", later)
    assert rows(spark.table(name)) == [(3, None, DAY), (4, None, DAY)]


def test_listings_of_an_attempt_do_not_grow_with_history(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"), "now")
    counts = []
    listed = files.folder_bytes
    monkeypatch.setattr("wattlake.sources.lake.folder_bytes", lambda s, p: counts.append(p) or listed(s, p))
    name = "gold_meter_anomalies"
    for n in range(50):
        os.makedirs(f"{tmp_path}/lake/gold/dataset={name}/dt={DAY - timedelta(days=n)}/run=r{n}/attempt=old")
    path = lake.path(name, DAY, "mine")
    spark.range(3).write.parquet(path)
    assert lake.bytes(name, DAY, "mine") == lake.bytes(name, DAY, "mine") > 0
    assert lake.read(name, {DAY: "mine", DAY + timedelta(days=1): "none"}).count() == 3
    assert counts == [path, lake.path(name, DAY + timedelta(days=1), "none")]


def test_many_dates_are_taken_back_by_one_read_and_one_append(spark, tmp_path, monkeypatch):
    house = Warehouse(spark, str(tmp_path / "w"))
    days = [DAY + timedelta(days=n) for n in range(4)]
    for run in ("one", "two"):
        made = [Target("gold.t", f"{tmp_path}/{run}/{d}", d, rows=n, schema="business_date date") for n, d in enumerate(days)]
        house.publish_many([(run, t) for t in made])
    reads, appends = [], []
    events, append = Warehouse.events, Warehouse._append
    monkeypatch.setattr(Warehouse, "events", lambda self: reads.append(1) or events(self))
    monkeypatch.setattr(Warehouse, "_append", lambda self, *a: appends.append(1) or append(self, *a))
    done = house.restore_many({d: "two" for d in days[:3]} | {days[3]: "none"}, "why")
    assert (len(reads), len(appends), len(done.events)) == (1, 1, 3)
    assert done.restored == [f"gold.t@{d}->run one" for d in days[:3]]
    assert [r.run_id for r in house.pointers().orderBy("business_date").collect()] == ["one"] * 3 + ["two"]
    assert house.restore_many({d: "two" for d in days[:3]}, "again").events == ()
