import random
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wattlake.operators import dedupe_and_difference, difference_by_key, latest_per_key
from wattlake.operators.keyed import with_day_boundary
from wattlake.operators.slices import hot_groups
from wattlake.plans.medallion import reject_reason

T0 = datetime(2024, 1, 1)


def steps(spark, values, **kwargs):
    data = [("m", T0 + timedelta(minutes=15 * i), v, 230.0) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, cumulative_kwh double, voltage double")
    return difference_by_key(
        df, ["k"], "ts", "cumulative_kwh", previous_value="prev_kwh", previous_time="prev_ts",
        difference="interval_kwh", **kwargs,
    )


@pytest.mark.parametrize("limit", [10**6, 2])
def test_reasons_cascade_through_rejected_rows(spark, limit):
    out = steps(spark, [10.0, None, 11.0, 500.0, 12.0, 12.5], max_group_rows=limit)
    got = [r[0] for r in out.orderBy("ts").select(reject_reason()).collect()]
    assert got == [
        "no_prior_reading", "null_reading", "no_prior_reading", "implausible_spike", "meter_rollback", None
    ]


def test_null_voltage_is_accepted_and_edges_are_inside(spark):
    out = steps(spark, [1.0, 2.0, 3.0, 4.0, 44.0]).orderBy("ts")
    volts = F.element_at(F.array(*map(F.lit, [230.0, None, 180.0, 260.0, 260.0])), F.row_number().over(
        __import__("pyspark.sql", fromlist=["Window"]).Window.orderBy("ts")))
    got = [r[0] for r in out.withColumn("voltage", volts).select(reject_reason()).collect()]
    assert got == ["no_prior_reading", None, None, None, None]
    low = steps(spark, [1.0, 2.0]).withColumn("voltage", F.lit(179.9)).orderBy("ts").select(reject_reason())
    assert low.collect()[1][0] == "voltage_out_of_range"


def readings(spark, seed=3, n=600):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        key = rng.choice(["hot", "hot", "hot", "a", "b", None])
        ts = T0 + timedelta(minutes=rng.randrange(150))
        data.append((key, ts, T0 + timedelta(seconds=rng.randrange(5)), rng.choice([None, *range(50)])))
    return spark.createDataFrame(data, "k string, ts timestamp_ntz, updated timestamp_ntz, v int")


def test_latest_is_the_same_on_any_partitioning(spark):
    df = readings(spark)
    expected = {}
    for r in df.collect():
        order = (r.updated, r.v is not None, r.v or 0)
        if (r.k, r.ts) not in expected or order > expected[r.k, r.ts][0]:
            expected[r.k, r.ts] = (order, tuple(r))
    wanted = sorted((row for _, row in expected.values()), key=repr)
    assert rows(latest_per_key(df, ["k", "ts"], "updated")) == wanted
    assert rows(latest_per_key(df.repartition(7), ["k", "ts"], "updated")) == wanted


def test_sliced_difference_equals_plain(spark):
    df = latest_per_key(readings(spark), ["k", "ts"], "updated")
    plain = rows(difference_by_key(df, ["k"], "ts", "v"))
    for limit in (3, 10, 40):
        assert rows(difference_by_key(df, ["k"], "ts", "v", max_group_rows=limit)) == plain


def test_dedupe_and_difference_paths_agree(spark):
    df = readings(spark)
    names = {"previous_value": "p", "previous_time": "pt", "difference": "d"}
    by_steps = rows(difference_by_key(latest_per_key(df, ["k", "ts"], "updated"), ["k"], "ts", "v", **names))
    for limit in (10**6, 20):
        assert rows(dedupe_and_difference(df, ["k"], "ts", "updated", "v", **names, max_group_rows=limit)) == by_steps


def test_hot_groups_are_cut_into_bounded_slices(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("k"),
        "id",
    )
    assert hot_groups(df, ["k"], "id", 5_000) is None
    hot = hot_groups(df, ["k"], "id", 500)
    sliced = hot.add_slices(df, "id")
    sizes = {tuple(r)[:2]: r["count"] for r in sliced.groupBy("k", "_slice").count().collect()}
    assert {k for k, s in sizes if s > 0} == {"hot"}
    assert sum(n for (k, _), n in sizes.items() if k == "hot") == 3334
    assert max(n for (k, _), n in sizes.items() if k == "hot") <= 2 * 500


def test_day_boundary(spark):
    data = [
        ("m", date(2024, 1, 1), T0, 1), ("m", date(2024, 1, 1), T0 + timedelta(hours=23), 2),
        ("m", date(2024, 1, 2), T0 + timedelta(hours=25), 3), ("m", date(2024, 1, 4), T0 + timedelta(hours=80), 4),
    ]
    df = spark.createDataFrame(data, "k string, day date, ts timestamp_ntz, v int")
    for limit in (10**6, 1):
        out = with_day_boundary(df, ["k"], "day", "ts", "v", "before", max_group_rows=limit).orderBy("ts")
        # The last row's previous day is missing, so nothing seeds it.
        assert [r.before for r in out.collect()] == [None, 1, 2, None]
