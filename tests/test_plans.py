"""The physical plans are the ones meant."""

import re
from datetime import date

import pytest

from wattlake.plans import medallion
from wattlake.plans.medallion import Options
from wattlake.sources.lake import Lake
from wattlake.sources.synthetic import seed_landing

DAY = date(2026, 8, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    seed_landing(spark, root, [DAY], 50)
    lake = Lake(spark, root)
    raw = {f"landing_{n}": lake.landing(f"landing_{n}", [DAY]) for n in ("readings", "meters", "tariffs", "weather")}
    return {k: medallion.BUILD[k](raw, Options()) for k in medallion.BUILD if k.startswith("bronze")}


def test_cleansing_shuffles_and_sorts_once(bronze):
    text = plan(medallion.silver_cleanse(bronze, Options()))
    assert len(re.findall(r"\bExchange\b", text)) == 1
    assert len(re.findall(r"\bSort \[", text)) == 1


def test_enrichment_does_not_shuffle_the_readings(bronze, spark):
    readings = bronze["bronze_readings"].withColumn("interval_kwh", bronze["bronze_readings"].cumulative_kwh)
    text = plan(medallion.silver_enrich({**bronze, "silver_readings": readings}, Options(dates=(DAY, DAY))))
    assert text.count("BroadcastHashJoin") >= 2
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_totals_read_only_the_columns_they_need(bronze, spark, tmp_path):
    path = str(tmp_path / "enriched")
    readings = bronze["bronze_readings"].withColumn("interval_kwh", bronze["bronze_readings"].cumulative_kwh)
    medallion.silver_enrich({**bronze, "silver_readings": readings}, Options()).write.parquet(path)
    text = medallion.daily_totals(spark.read.parquet(path))._jdf.queryExecution().toString()
    assert "ReadSchema" in text
    read = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    columns = {c.split("#")[0] for c in read.split(",")}
    assert columns == {"business_date", "region", "meter_id", "interval_kwh", "cost_eur", "is_peak", "temp_c"}


def test_scores_read_their_input_once(spark):
    from wattlake.plans.operator_queries import _scored

    before = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    text = plan(_scored(spark, "/root/testdata/sf0.001"))
    # The input is written once; what is left is a broadcast of the groups to it.
    assert "FileScan" not in text and len(re.findall(r"\bExchange\b", text)) <= 3
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert spark.sparkContext._jsc.sc().dagScheduler().nextJobId() - before <= 16
