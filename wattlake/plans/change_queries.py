"""Registered queries on data that arrives late, changes or cannot be read."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.operators.changes import changed_intervals, touched_dates
from wattlake.operators.rejects import REASON, cast_or_reason
from wattlake.plans.incremental import MeterSums
from wattlake.plans.registry import query, table
from wattlake.plans.telemetry_queries import _DAILY_SELECT, _GOLD_SQL, _WEEK, bronze
from wattlake.session import scratch_path
from wattlake.sources.footers import footers
from wattlake.streaming.event_time import append_closed, windowed_totals


def _in_two_batches(spark, folder) -> MeterSums:
    """Sums after readings of three morning hours of every fifth meter came a batch late."""
    frames = bronze(spark, folder)
    readings = frames.pop("bronze_readings")
    late = F.hour("reading_ts").between(6, 8) & (F.substring("meter_id", -1, 1).isin("0", "5"))
    kept = MeterSums(spark, scratch_path(spark, "meter_sums"))
    kept.arrive(0, readings.filter(~late), frames)
    kept.arrive(1, readings.filter(late), frames)
    return kept


@query("gold_daily_region_late", f"WITH {_GOLD_SQL} {_DAILY_SELECT.format(week=_WEEK['run'])}")
def _gold_daily_region_late(spark, folder):
    return _in_two_batches(spark, folder).daily_region()


@query(
    "gold_region_after_price_change",
    f"WITH {_GOLD_SQL} {_DAILY_SELECT.format(week=_WEEK['run'])}",
)
def _gold_region_after_price_change(spark, folder):
    """Sums made with prices that were all an eighth higher in the evening, then corrected."""
    frames = bronze(spark, folder)
    readings = frames.pop("bronze_readings")
    price = F.col("price_per_kwh") + F.when(F.hour("valid_from") >= 18, 0.125).otherwise(0.0)
    wrong = frames["bronze_tariffs"].withColumn("price_per_kwh", price)
    kept = MeterSums(spark, scratch_path(spark, "meter_sums"))
    kept.arrive(0, readings, frames | {"bronze_tariffs": wrong})
    kept.dimension_changed(1, "bronze_tariffs", wrong, frames)
    return kept.daily_region()


_STATUS_SQL = """
WITH old AS (
    SELECT o_custkey AS k, o_orderdate AS since, max(o_orderpriority) AS v FROM orders
    WHERE o_orderkey % 7 <> 0 GROUP BY ALL
), new AS (
    SELECT o_custkey AS k, o_orderdate AS since, max(o_orderpriority) AS v FROM orders GROUP BY ALL
), points AS (
    SELECT k, since, lead(since) OVER (PARTITION BY k ORDER BY since) AS until
    FROM (SELECT k, since FROM old UNION SELECT k, since FROM new)
), seen AS (
    SELECT p.*, o.v AS was, n.v AS now
    FROM points p ASOF LEFT JOIN old o ON p.k = o.k AND p.since >= o.since
    ASOF LEFT JOIN new n ON p.k = n.k AND p.since >= n.since
)"""


def _snapshots(spark, folder):
    orders = table(spark, folder, "orders")
    columns = [F.col("o_custkey").alias("k"), F.col("o_orderdate").cast("timestamp_ntz").alias("since"), F.col("o_orderpriority").alias("v")]
    new = orders.select(*columns)
    return orders.filter("o_orderkey % 7 <> 0").select(*columns), new


@query(
    "snapshot_changes",
    _STATUS_SQL + """
SELECT k, since::TIMESTAMP AS since, until::TIMESTAMP AS until
FROM seen WHERE was IS DISTINCT FROM now""",
)
def _snapshot_changes(spark, folder):
    """When each customer's priority in force differs, if every seventh order was missing from the old snapshot."""
    return changed_intervals(*_snapshots(spark, folder), ["k"], "since")


@query(
    "snapshot_touched_dates",
    _STATUS_SQL + """, days AS (SELECT DISTINCT o_orderdate::DATE AS touched FROM orders)
SELECT d.touched, count(DISTINCT k) AS customers
FROM days d JOIN seen s ON was IS DISTINCT FROM now AND s.since::DATE <= d.touched
 AND (s.until IS NULL OR s.until::DATE > d.touched)
GROUP BY ALL""",
)
def _snapshot_touched_dates(spark, folder):
    """How many customers' priorities differ on each date with orders."""
    old, new = _snapshots(spark, folder)
    days = new.select(F.to_date("since").alias("touched")).distinct()
    span = days.agg(F.min("touched"), F.max("touched")).first()
    touched = touched_dates(changed_intervals(old, new, ["k"], "since"), *span, "k")
    # A customer has a date once, so counting needs no customers kept; the dates of a calendar are few.
    return touched.join(F.broadcast(days), "touched", "left_semi").groupBy("touched").agg(F.count("k").alias("customers"))


@query(
    "event_time_totals",
    """WITH w AS (
        SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n, CAST(sum(floor(value)) AS BIGINT) AS total
        FROM events GROUP BY 1, 2
    )
    SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type, n, total
    FROM w WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)""",
)
def _event_time_totals(spark, folder):
    """Daily totals by event type from a stream over the events; days still open at its end are not told."""
    given = table(spark, folder, "events")
    # By a pattern, as the table may be one file, and a stream's plain path has to be a folder.
    stream = spark.readStream.schema(given.schema).parquet(f"{folder}/event[s].parquet")
    totals = {"n": F.count(F.lit(1)), "total": F.sum(F.floor("value")).cast("long")}
    closed = windowed_totals(stream, "ts", ["event_type"], totals, width="1 day", delay="2 hours", unique=["event_id"])
    path = scratch_path(spark, "event_time")
    append_closed(closed, f"{path}/rows", f"{path}/state").awaitTermination()
    return spark.read.schema(closed.schema).parquet(f"{path}/rows")


@query(
    "rejected_values",
    """WITH raw AS (
        SELECT CAST(ts AS DATE) AS dt,
               CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS kwh,
               CASE WHEN event_id % 11 = 0 THEN 'M' || user_id ELSE CAST(user_id AS VARCHAR) END AS meter
        FROM events
    )
    SELECT dt, count(*) AS readings, count(*) FILTER (WHERE try_cast(kwh AS DOUBLE) IS NULL) AS bad_kwh,
           count(*) FILTER (WHERE try_cast(meter AS BIGINT) IS NULL) AS bad_meter,
           CAST(sum(try_cast(kwh AS DOUBLE)) AS BIGINT) AS kwh
    FROM raw GROUP BY dt""",
)
def _rejected_values(spark, folder):
    """Readings of each date whose texts are no numbers, beside the sum of those that are; one pass."""
    number = F.floor("value").cast("long").cast("string")
    raw = table(spark, folder, "events").select(
        F.to_date("ts").alias("dt"), F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(number).alias("kwh"),
        F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("M"), F.col("user_id").cast("string"))).otherwise(F.col("user_id").cast("string")).alias("meter"),
    )
    cast = cast_or_reason(raw, {"kwh": "double", "meter": "bigint"})
    bad = lambda c: F.exists(REASON, lambda x: x.startswith(f"{c}: "))
    return cast.groupBy("dt").agg(
        F.count(F.lit(1)).alias("readings"), F.count_if(bad("kwh")).alias("bad_kwh"), F.count_if(bad("meter")).alias("bad_meter"),
        F.sum("kwh").cast("long").alias("kwh"),
    )


_COUNTED = ("customer", "orders", "lineitem", "events", "documents", "pages")


@query(
    "footer_rows",
    " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows, true AS has_groups, true AS has_bytes FROM {t}" for t in _COUNTED),
)
def _footer_rows(spark, folder):
    """Rows of each table by its footers, and whether row groups and column sizes are told."""
    found = footers(spark, *(f"{folder}/{t}.parquet" for t in _COUNTED))
    name = F.regexp_extract("path", r"/(\w+)\.parquet(?:/|$)", 1)
    sizes = F.aggregate("columns", F.lit(0).cast("long"), lambda a, c: a + c["compressed"])
    return found.groupBy(name.alias("name")).agg(
        F.sum("rows").alias("rows"), (F.sum("row_groups") > 0).alias("has_groups"), (F.sum(sizes) > 0).alias("has_bytes")
    )
