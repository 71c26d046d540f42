import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions import cents, epoch_hours, path_segment, round_to, run_id_of, safe_divide, to_hour


def reference_round(x, n):
    scaled = x * 10**n
    whole = math.floor(abs(scaled))
    return math.copysign(whole + (1 if abs(scaled) - whole >= 0.5 else 0), scaled) / 10**n


def test_round_uses_the_binary_value(spark):
    values = [1.005, 2.675, -1.005, 0.5, 1.5, 2.5, -2.5, 0.49999999999999994, 1e17 + 0.1, 123456.789, -0.0, 1e300]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (1, 2, 3, 4, 5):
        got = [r[0] for r in df.select(round_to(F.col("x"), digits)).collect()]
        for value, result in zip(values, got):
            expected = value if abs(value * 10**digits) >= 2.0**52 else reference_round(value, digits)
            assert result == expected, (value, digits)


def test_round_keeps_null_nan_infinity_and_sign(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (-0.001,)], "x double")
    null, nan, inf, small = [r[0] for r in df.select(round_to(F.col("x"), 2)).collect()]
    assert null is None and math.isnan(nan) and math.isinf(inf)
    assert small == 0 and math.copysign(1, small) == -1


def test_divide_by_zero_is_null(spark):
    row = spark.sql("SELECT 1.0D AS a, 0.0D AS b").select(safe_divide(F.col("a"), F.col("b"))).first()
    assert row[0] is None


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_hours_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # Includes an hour that does not exist in Berlin.
        times = [datetime(2024, 3, 31, 2, 30), datetime(2024, 10, 27, 2, 59, 59), datetime(1969, 12, 31, 23, 1)]
        df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
        got = df.select(to_hour(F.col("ts")), epoch_hours(F.col("ts"), T.TimestampNTZType())).collect()
        for t, (hour, number) in zip(times, got):
            assert hour == t.replace(minute=0, second=0)
            assert number == math.floor((t - datetime(1970, 1, 1)).total_seconds() / 3600)
        assert df.select(to_hour(F.col("ts")).alias("h")).schema["h"].dataType == T.TimestampNTZType()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_epoch_hours_of_dates_and_other_types(spark):
    df = spark.createDataFrame([(date(1970, 1, 3),)], "d date")
    assert df.select(epoch_hours(F.col("d"), T.DateType())).first()[0] == 48
    with pytest.raises(TypeError):
        epoch_hours(F.col("d"), T.StringType())


def test_paths(spark):
    path = F.lit("file:/lake/silver/dataset=silver_readings/dt=2026-08-01/run=007/part-0.parquet")
    got = spark.range(1).select(
        path_segment(path, "file:/lake", 1), path_segment(path, "file:/lake/", 2), run_id_of(path),
        run_id_of(F.lit("file:/lake/landing/x.csv")), cents(F.lit(12.34)),
    ).first()
    assert tuple(got) == ("silver", "silver_readings", "007", None, 1234)
