"""Reading, writing, publishing and reporting, over the given tables.

Whatever is written goes to a fresh folder below the shared checkpoint folder.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake import reports
from wattlake.operators import latest_per_key
from wattlake.plans import medallion
from wattlake.plans.catalog import STEPS
from wattlake.plans.medallion import Options
from wattlake.plans.operator_queries import _LATEST_SQL
from wattlake.plans.registry import query, table
from wattlake.plans.run import Engine
from wattlake.plans.telemetry_queries import (
    _DAILY_SELECT,
    _GOLD_SQL,
    _SILVER_SQL,
    _WEEK,
    bronze,
    enriched,
    landing,
)
from wattlake.publish import Target, Warehouse
from wattlake.quality import Expectation
from wattlake.runlog import latest_runs
from wattlake.session import scratch_path
from wattlake.sources import files, footers
from wattlake.sources.lake import Lake, query as ad_hoc, read_source, register_source

_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# --- sources and sinks ----------------------------------------------------


@query(
    "table_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in _TABLES),
)
def _table_counts(spark, folder):
    return reports.row_counts({name: table(spark, folder, name) for name in _TABLES})


@query(
    "input_footprint",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, 1 AS files, count(*) AS rows, true AS has_bytes FROM {t}" for t in _TABLES),
)
def _input_footprint(spark, folder):
    sizes = footers.footprint(spark, [f"{folder}/{name}.parquet" for name in _TABLES])
    return sizes.select(
        F.regexp_extract("path", "([a-z]+)\\.parquet$", 1).alias("table_name"), "files", "rows",
        (F.col("bytes") > 0).alias("has_bytes"),
    )


@query(
    "input_size_class",
    """SELECT source, count(DISTINCT lang) AS files, count(*) AS rows, sum(n_chars)::BIGINT AS bytes,
              if(sum(n_chars) >= 125000, 'roomy', 'lean') AS class
       FROM documents GROUP BY source""",
)
def _input_size_class(spark, folder):
    """Documents by source as inputs: their languages stand in for files and their characters for bytes."""
    sizes = table(spark, folder, "documents").groupBy("source", F.col("lang")).agg(
        F.lit(1).alias("files"), F.count(F.lit(1)).alias("rows"), F.sum("n_chars").alias("bytes")
    )
    return files.size_class(sizes, threshold_mb=0.125, by=("source",))


_PROFILED = {"lineitem": ("l_quantity", "l_discount", "l_linenumber", "l_returnflag"), "customer": ("c_acctbal", "c_nationkey", "c_mktsegment", "c_name")}


def _profile_sql(table_name: str, column: str) -> str:
    text = column in ("l_returnflag", "c_mktsegment", "c_name")
    number, words = ("NULL::DOUBLE", "{0}::VARCHAR") if text else ("{0}::DOUBLE", "NULL::VARCHAR")
    quantile = "NULL::DOUBLE" if text else f"quantile_disc({column}, {{q}})::DOUBLE"
    return (
        f"SELECT '{table_name}' AS table_name, '{column}' AS column_name, count(*) AS rows, "
        f"(count(*) - count({column})) / count(*) AS null_share, count(DISTINCT {column}) AS distinct_values, "
        f"{number.format(f'min({column})')} AS least, {number.format(f'max({column})')} AS greatest, "
        f"{words.format(f'min({column})')} AS first_text, {words.format(f'max({column})')} AS last_text, "
        f"{quantile.format(q=0.25)} AS lower_quartile, {quantile.format(q=0.5)} AS median, "
        f"{quantile.format(q=0.75)} AS upper_quartile FROM {table_name}"
    )


@query("column_profile", " UNION ALL ".join(_profile_sql(t, c) for t, columns in _PROFILED.items() for c in columns))
def _column_profile(spark, folder):
    parts = [
        reports.column_profile(table(spark, folder, t).select(*columns), exact_distinct=True).select(F.lit(t).alias("table_name"), "*")
        for t, columns in _PROFILED.items()
    ]
    return parts[0].unionByName(parts[1])


_AD_HOC = """SELECT o_orderpriority, o_orderstatus, count(*) AS orders, max(o_totalprice) AS largest
             FROM orders GROUP BY ALL ORDER BY 1, 2"""


@query("ad_hoc_sql", _AD_HOC)
def _ad_hoc_sql(spark, folder):
    register_source(spark, "orders", f"{folder}/orders.parquet")
    return ad_hoc(spark, _AD_HOC)


@query("csv_round_trip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _csv_round_trip(spark, folder):
    path = scratch_path(spark, "csv")
    table(spark, folder, "customer").write.option("header", True).csv(path)
    # Another column order than the file's: columns are matched by name.
    return read_source(
        spark, path, "csv",
        "c_mktsegment string, c_custkey bigint, c_name string, c_nationkey int, c_acctbal double",
    )


@query("csv_inferred", "SELECT * FROM orders")
def _csv_inferred(spark, folder):
    path = scratch_path(spark, "csv")
    table(spark, folder, "orders").write.option("header", True).csv(path)
    return read_source(spark, path, "csv")


@query(
    "columns_by_name",
    """SELECT event_id, user_id, value, NULL AS event_type FROM events
       UNION ALL BY NAME SELECT event_type, event_id FROM events""",
)
def _columns_by_name(spark, folder):
    events, path = table(spark, folder, "events"), scratch_path(spark, "merge")
    events.select("event_id", "user_id", "value").write.parquet(f"{path}/part=a")
    events.select("event_type", "event_id").write.parquet(f"{path}/part=b")
    return read_source(spark, path).drop("part")


def _cleansed_lake(spark: SparkSession, folder: str) -> Lake:
    lake = Lake(spark, scratch_path(spark, "lake"), "only")
    rows = medallion.silver_cleanse(bronze(spark, folder), Options())
    day = F.col("business_date")
    lake.write("silver", rows, F.col("dataset"), day, F.concat(F.lit("r-"), day.cast("string")), many_dates=True)
    return lake


@query(
    "run_scoped_write",
    f"""WITH {_SILVER_SQL}
    SELECT 'r-' || business_date AS run, business_date AS dt, reject_reason, count(*) AS rows,
           max(reading_ts) AS newest, sum(voltage) AS volts
    FROM silver_quarantine GROUP BY ALL""",
)
def _run_scoped_write(spark, folder):
    history = _cleansed_lake(spark, folder).history("silver_quarantine")
    return history.groupBy("run", "dt", "reject_reason").agg(
        F.count(F.lit(1)).alias("rows"), F.max("reading_ts").alias("newest"), F.sum("voltage").alias("volts")
    )


@query(
    "lake_inventory",
    f"""WITH {_SILVER_SQL}
    SELECT 'silver' AS layer, 'silver_readings' AS dataset, count(DISTINCT business_date) AS files,
           count(DISTINCT business_date) AS runs
    FROM silver_readings
    UNION ALL
    SELECT 'silver', 'silver_quarantine', count(DISTINCT business_date), count(DISTINCT business_date)
    FROM silver_quarantine""",
)
def _lake_inventory(spark, folder):
    lake = _cleansed_lake(spark, folder)
    return files.inventory(spark, lake.root)


# --- publishing -----------------------------------------------------------

_RESTORED = (date(2024, 1, 15), date(2024, 1, 16))


@query(
    "publish_and_restore",
    f"""WITH {_GOLD_SQL}
    SELECT business_date, region, meters,
           CASE WHEN business_date IN (DATE '2024-01-15', DATE '2024-01-16') THEN kwh ELSE 2 * kwh END AS kwh
    FROM totals""",
)
def _publish_and_restore(spark, folder):
    """Two runs of every date; the second replaces the first and is taken back on two dates."""
    return _published_twice(spark, folder).table("gold.daily")


def _published_twice(spark, folder) -> Warehouse:
    root = scratch_path(spark, "publish")
    daily = medallion.daily_totals(enriched(spark, folder)).select("business_date", "region", "meters", "kwh")
    warehouse = Warehouse(spark, f"{root}/warehouse")
    for run, factor in (("first", 1), ("second", 2)):
        out = daily.withColumns({
            "kwh": factor * F.col("kwh"), "dt": F.col("business_date"), "run": F.lit(run)
        })
        out.hint("rebalance", "dt").write.partitionBy("dt", "run").mode("append").parquet(f"{root}/gold")
        days = [r.dt for r in spark.read.parquet(f"{root}/gold").filter(F.col("run") == run).select("dt").distinct().collect()]
        warehouse.publish(run, [
            Target("gold.daily", f"{root}/gold/dt={day}/run={run}", day) for day in sorted(days)
        ])
    for day in _RESTORED:
        warehouse.restore("second", day, "taken back")
    return warehouse


@query(
    "publish_log",
    f"""WITH {_GOLD_SQL},
    dates AS (SELECT business_date, count(*) AS n FROM totals GROUP BY 1)
    SELECT 'first' AS run_id, 'gold.daily' AS table_name, business_date, 0 AS rows_deleted, n AS rows_written,
           '' AS previous_run_id, false AS compensated
    FROM dates
    UNION ALL
    SELECT 'second', 'gold.daily', business_date, n, n, 'first',
           business_date IN (DATE '2024-01-15', DATE '2024-01-16')
    FROM dates""",
)
def _publish_log(spark, folder):
    """One row per run and date: what it replaced, whose files those were, and whether it was taken back."""
    return _published_twice(spark, folder).publish_log().select(
        "run_id", "table_name", "business_date", "rows_deleted", "rows_written", "previous_run_id", "compensated"
    )


@query(
    "publish_by_name",
    """WITH days AS (
        SELECT CAST(ts AS DATE) AS business_date, event_type, count(*) AS n, sum(floor(value)) AS amount
        FROM events GROUP BY 1, 2
    )
    SELECT business_date, event_type, n, amount FROM days WHERE business_date < DATE '2024-01-16'
    UNION ALL
    SELECT business_date, event_type, NULL, amount FROM days WHERE business_date >= DATE '2024-01-16'""",
)
def _publish_by_name(spark, folder):
    """The first publish gives the columns; a later one has them in another order and lacks one."""
    root = scratch_path(spark, "named")
    daily = table(spark, folder, "events").groupBy(F.to_date("ts").alias("business_date"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.floor("value").cast("double")).alias("amount")
    ).withColumn("dt", F.col("business_date"))
    late = F.col("business_date") >= F.lit(_NAMED_FROM)
    warehouse = Warehouse(spark, f"{root}/warehouse")
    daily.filter(~late).write.partitionBy("dt").parquet(f"{root}/early")
    daily.filter(late).select("amount", "event_type", "business_date", "dt").write.partitionBy("dt").parquet(f"{root}/late")
    for run in ("early", "late"):
        days = [r.business_date for r in spark.read.parquet(f"{root}/{run}").select("business_date").distinct().collect()]
        warehouse.publish(run, [Target("gold.events", f"{root}/{run}/dt={day}", day) for day in sorted(days)])
    return warehouse.table("gold.events")


_NAMED_FROM = date(2024, 1, 16)


#: The catalog's gates with the value sets of the given tables, and counts that suit some thirty readings a day.
_OWN_VALUES = {
    "region": ["africa", "america", "asia", "europe", "middle east"],
    "tariff_plan": ["automobile", "building", "furniture", "household", "machinery"],
}
_OWN_LEAST = {"bronze_readings": 10, "silver_readings": 5}


def _own_steps():
    def own(e):
        if e.kind == "accepted_values" and e.column in _OWN_VALUES:
            return replace(e, params={"values": _OWN_VALUES[e.column]})
        if e.kind == "row_count_min" and e.dataset in _OWN_LEAST:
            return replace(e, params={"min": _OWN_LEAST[e.dataset]})
        return e

    return {key: replace(s, expectations=tuple(map(own, s.expectations))) for key, s in STEPS.items()}


@query(
    "backfill_daily_region",
    f"WITH {_GOLD_SQL} {_DAILY_SELECT.format(week=_WEEK['run'])}",
)
def _backfill_daily_region(spark, folder):
    """Landing files of all dates, every step over all of them at once, gates per date, one publish."""
    engine, first, last = _landed(spark, folder)
    engine.backfill(first, last)
    return engine.warehouse.table("gold.daily_region_consumption")


def _landed(spark, folder) -> tuple[Engine, date, date]:
    """An engine over the landing files of all dates, and the first and last of them."""
    root = scratch_path(spark, "backfill")
    raw = landing(spark, folder)

    def land(name: str) -> None:
        path = f"{root}/lake/landing/{name}"
        if "dt" in raw[name].columns:
            raw[name].hint("rebalance", "dt").write.partitionBy("dt").parquet(path)
        else:
            raw[name].write.option("header", True).csv(path)

    with ThreadPoolExecutor(max_workers=len(raw)) as pool:  # side by side, as the steps that read them
        list(pool.map(land, raw))
    first, last = table(spark, folder, "events").agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    return Engine(spark, f"{root}/lake", f"{root}/warehouse", steps=_own_steps()), first, last


@query(
    "republish_failed_gate",
    f"WITH {_GOLD_SQL} {_DAILY_SELECT.format(week=_WEEK['run'])}",
)
def _republish_failed_gate(spark, folder):
    """A backfill, and a second one under the same run ids whose last gate fails on every date."""
    engine, first, last = _landed(spark, folder)
    engine.backfill(first, last)
    gold = engine.steps["gold_daily_region"]
    never = Expectation("row_count_max", "gold_daily_region", params={"max": 0}, name="never")
    failing = dict(engine.steps) | {"gold_daily_region": replace(gold, expectations=(*gold.expectations, never))}
    Engine(spark, engine.lake.root, engine.warehouse.root, steps=failing).backfill(first, last)
    return engine.warehouse.table("gold.daily_region_consumption")


@query(
    "backfill_step_metrics",
    f"""WITH {_GOLD_SQL},
    days AS (SELECT DISTINCT business_date FROM bronze_readings),
    counts AS (
        SELECT business_date,
               (SELECT count(*) FROM bronze_readings r WHERE r.business_date = d.business_date) AS raw,
               (SELECT count(*) FROM silver_readings r WHERE r.business_date = d.business_date) AS accepted,
               (SELECT count(*) FROM silver_quarantine r WHERE r.business_date = d.business_date) AS rejected,
               (SELECT count(*) FROM silver_enriched r WHERE r.business_date = d.business_date) AS enriched,
               (SELECT count(*) FROM totals r WHERE r.business_date = d.business_date) AS regions
        FROM days d
    )
    SELECT 'backfill-' || business_date AS run_id, unnest(['bronze_readings', 'silver_cleanse', 'silver_enrich', 'gold_daily_region']) AS step_key,
           'succeeded' AS state, unnest([raw, accepted, enriched, regions]) AS rows_out, unnest([0, rejected, 0, 0]) AS rows_rejected
    FROM counts""",
)
def _backfill_step_metrics(spark, folder):
    """What the run log says of every step of every date after a full backfill."""
    engine, first, last = _landed(spark, folder)
    engine.backfill(first, last)
    kept = F.col("step_key").isin("bronze_readings", "silver_cleanse", "silver_enrich", "gold_daily_region")
    return engine.log.table("step_metrics").filter(kept).select("run_id", "step_key", "state", "rows_out", "rows_rejected")


# --- records and reports --------------------------------------------------
# Orders stand in for runs, order lines for their steps and checks.


def _runs(spark, folder) -> DataFrame:
    orders = table(spark, folder, "orders")
    started = F.col("o_orderdate") + F.expr("INTERVAL '1' SECOND") * F.pmod("o_orderkey", F.lit(86400)).cast("int")
    finished = started + F.expr("INTERVAL '1' SECOND") * F.pmod("o_orderkey", F.lit(977)).cast("int")
    common = [
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run_id"),
        F.concat(F.lit("wf-"), F.col("o_custkey").cast("string")).alias("workflow_id"),
        F.to_date("o_orderdate").alias("business_date"),
        F.col("o_orderpriority").alias("mode"),
    ]
    opened = orders.select(
        *common, F.lit("running").alias("status"), started.alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("finished_at"),
        F.lit(0).cast("long").alias("rows_published"), F.lit("").alias("error"), F.lit(1).alias("seq"),
    )
    closed = orders.select(
        *common, F.when(F.col("o_orderstatus") == "F", "failed").otherwise("succeeded").alias("status"),
        (started + F.expr("INTERVAL '1' DAY")).alias("started_at"), finished.alias("finished_at"),
        F.col("o_orderkey").alias("rows_published"),
        F.when(
            F.col("o_orderstatus") == "F",
            F.concat(F.repeat(F.lit("quality gate failed; "), F.lit(4)), "o_orderpriority"),
        ).otherwise("").alias("error"),
        F.lit(2).alias("seq"),
    )
    return latest_runs(opened.unionByName(closed))


_RUNS_SQL = """
runs AS (
    SELECT 'run-' || o_orderkey AS run_id, 'wf-' || o_custkey AS workflow_id,
           CAST(o_orderdate AS DATE) AS business_date, o_orderpriority AS mode,
           CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'succeeded' END AS status,
           o_orderdate + to_seconds(o_orderkey % 86400) AS started_at,
           o_orderdate + to_seconds(o_orderkey % 86400) + to_seconds(o_orderkey % 977) AS finished_at,
           o_orderkey AS rows_published,
           CASE WHEN o_orderstatus = 'F' THEN repeat('quality gate failed; ', 4) || o_orderpriority ELSE '' END AS error
    FROM orders
),
newest AS (SELECT run_id FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 1)"""


def _steps(spark, folder) -> DataFrame:
    lines = latest_per_key(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")
    return lines.select(
        F.concat(F.lit("run-"), F.col("l_orderkey").cast("string")).alias("run_id"),
        F.concat(F.lit("step-"), F.col("l_linenumber").cast("string")).alias("step_key"),
        F.col("l_linestatus").alias("layer"),
        F.when(F.col("l_returnflag") == "R", "failed").otherwise("succeeded").alias("state"),
        F.lit(1).alias("attempts"),
        F.col("l_partkey").alias("rows_in"), F.col("l_suppkey").alias("rows_out"),
        (F.col("l_partkey") - F.col("l_suppkey")).alias("rows_rejected"),
        (F.col("l_extendedprice") / 1000).alias("duration_seconds"),
        F.lit("").alias("memory_limit"), F.lit(8).alias("threads"),
        F.col("l_quantity").cast("int").alias("sla_seconds"),
        (F.col("l_extendedprice") / 1000 > F.col("l_quantity")).alias("sla_breached"),
    )


_STEPS_SQL = f"""
step_metrics AS (
    SELECT 'run-' || l_orderkey AS run_id, 'step-' || l_linenumber AS step_key, l_linestatus AS layer,
           CASE WHEN l_returnflag = 'R' THEN 'failed' ELSE 'succeeded' END AS state, 1 AS attempts,
           l_partkey AS rows_in, l_suppkey AS rows_out, l_partkey - l_suppkey AS rows_rejected,
           l_extendedprice / 1000 AS duration_seconds, '' AS memory_limit, 8 AS threads,
           CAST(l_quantity AS INTEGER) AS sla_seconds, l_extendedprice / 1000 > l_quantity AS sla_breached
    FROM ({_LATEST_SQL})
)"""


@query("latest_runs", f"WITH {_RUNS_SQL} SELECT * FROM runs")
def _latest_runs(spark, folder):
    return _runs(spark, folder)


@query(
    "report_runs",
    f"""WITH {_RUNS_SQL}
    SELECT run_id, business_date, mode, status, rows_published,
           round(CAST(date_diff('second', started_at, finished_at) AS DOUBLE), 1) AS secs,
           nullif("left"(error, 60), '') AS error
    FROM runs ORDER BY started_at DESC, run_id LIMIT 10""",
)
def _report_runs(spark, folder):
    return reports.runs(_runs(spark, folder))


@query(
    "report_runs_of_date",
    f"""WITH {_RUNS_SQL}
    SELECT run_id, business_date, mode, status, rows_published,
           round(CAST(date_diff('second', started_at, finished_at) AS DOUBLE), 1) AS secs,
           nullif("left"(error, 60), '') AS error
    FROM runs WHERE business_date = DATE '1998-10-03' ORDER BY started_at DESC, run_id LIMIT 10""",
)
def _report_runs_of_date(spark, folder):
    return reports.runs(_runs(spark, folder), date(1998, 10, 3))


@query(
    "report_step_metrics",
    f"""WITH {_RUNS_SQL}, {_STEPS_SQL}
    SELECT step_key, layer, state, attempts, rows_in, rows_out, rows_rejected,
           round(duration_seconds, 2) AS secs, memory_limit, threads, sla_breached
    FROM step_metrics WHERE run_id = (SELECT run_id FROM newest) ORDER BY layer, step_key""",
)
def _report_step_metrics(spark, folder):
    return reports.latest_step_metrics(_steps(spark, folder), _runs(spark, folder))


@query(
    "report_steps_of_run",
    f"""WITH {_STEPS_SQL}
    SELECT step_key, state, attempts, rows_in, rows_out, rows_rejected, round(duration_seconds, 2) AS secs,
           memory_limit AS mem, threads AS thr
    FROM step_metrics WHERE run_id = 'run-5' ORDER BY layer, step_key""",
)
def _report_steps_of_run(spark, folder):
    return reports.steps_of_run(_steps(spark, folder), "run-5")


@query(
    "report_failed_checks",
    f"""WITH {_RUNS_SQL}, {_STEPS_SQL}
    SELECT step_key, 'check-' || rows_in AS check_name, state AS severity,
           CAST(rows_out AS VARCHAR) AS observed, CAST(rows_in AS VARCHAR) AS expected
    FROM step_metrics WHERE run_id = (SELECT run_id FROM newest) AND NOT sla_breached
    ORDER BY state, step_key""",
)
def _report_failed_checks(spark, folder):
    checks = _steps(spark, folder).select(
        "run_id", "step_key", F.concat(F.lit("check-"), F.col("rows_in").cast("string")).alias("check_name"),
        F.col("state").alias("severity"), F.col("sla_breached").alias("passed"),
        F.col("rows_out").cast("string").alias("observed"), F.col("rows_in").cast("string").alias("expected"),
    )
    return reports.latest_failed_checks(checks, _runs(spark, folder))


@query(
    "report_publishes",
    f"""WITH {_RUNS_SQL}
    SELECT run_id, mode AS table_name, business_date, rows_published AS rows_deleted,
           rows_published AS rows_written, nullif(error, '') AS replaced_run, status = 'failed' AS compensated
    FROM runs ORDER BY finished_at DESC, run_id, mode LIMIT 20""",
)
def _report_publishes(spark, folder):
    log = _runs(spark, folder).select(
        "run_id", F.col("mode").alias("table_name"), "business_date",
        F.col("rows_published").alias("rows_deleted"), F.col("rows_published").alias("rows_written"),
        F.col("error").alias("previous_run_id"), (F.col("status") == "failed").alias("compensated"),
        F.col("finished_at").alias("published_at"),
    )
    return reports.publishes(log)


@query(
    "report_lineage",
    f"""WITH {_RUNS_SQL}
    SELECT DISTINCT 'part-' || l_partkey AS upstream, '->' AS dir, 'supplier-' || l_suppkey AS downstream,
           'step-' || l_linenumber AS step_key
    FROM lineitem WHERE 'run-' || l_orderkey = (SELECT run_id FROM newest)
    ORDER BY step_key, upstream""",
)
def _report_lineage(spark, folder):
    def named(prefix: str, column: str):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    edges = table(spark, folder, "lineitem").select(
        named("run-", "l_orderkey").alias("run_id"), named("step-", "l_linenumber").alias("step_key"),
        named("part-", "l_partkey").alias("upstream"), named("supplier-", "l_suppkey").alias("downstream"),
    )
    return reports.latest_lineage(edges, _runs(spark, folder))


@query(
    "report_daily_by_region",
    f"""WITH {_GOLD_SQL}, gold AS ({_DAILY_SELECT.format(week=_WEEK['run'])})
    SELECT business_date, region, meters, kwh, cost_eur, peak_share_pct, kwh_per_meter, kwh_7d_avg, rank_in_day
    FROM gold ORDER BY business_date DESC, rank_in_day, region LIMIT 20""",
)
def _report_daily_by_region(spark, folder):
    return reports.daily_by_region(
        medallion.gold_daily_region({"silver_enriched": enriched(spark, folder)}, Options())
    )


@query(
    "report_flagged_meters",
    f"""WITH {_GOLD_SQL}
    SELECT business_date, region, meter_id, capacity_kw, kwh, kwh_per_kw, round(z, 3) AS z_score,
           if(abs(z) >= 3, 'severe', 'watch') AS anomaly_band
    FROM standing WHERE abs(z) >= 2
    ORDER BY abs(round(z, 3)) DESC, business_date, meter_id LIMIT 20""",
)
def _report_flagged_meters(spark, folder):
    return reports.flagged_meters(
        medallion.gold_meter_anomalies({"silver_enriched": enriched(spark, folder)}, Options())
    )


@query(
    "run_rollup",
    f"""WITH {_RUNS_SQL}, {_STEPS_SQL}
    SELECT run_id, count(*) FILTER (WHERE state = 'succeeded') AS steps_succeeded,
           count(*) FILTER (WHERE state = 'failed') AS steps_failed,
           any_value(runs.status) AS status, any_value(runs.rows_published) AS rows_published
    FROM step_metrics JOIN runs USING (run_id) GROUP BY run_id""",
)
def _run_rollup(spark, folder):
    return reports.run_rollup(_steps(spark, folder), _runs(spark, folder))


@query(
    "sla_breaches",
    f"""WITH {_STEPS_SQL}
    SELECT run_id, step_key, sla_seconds, duration_seconds FROM step_metrics
    WHERE duration_seconds > sla_seconds""",
)
def _sla_breaches(spark, folder):
    return reports.sla_breaches(_steps(spark, folder))


@query(
    "lineage_edges",
    f"""WITH {_RUNS_SQL}, declared(step_key, downstream, upstream) AS (VALUES
        {', '.join(f"('{s.key}', '{down}', '{up}')" for s in STEPS.values() for up, down in s.lineage())}
    )
    SELECT run_id, step_key, upstream, downstream FROM runs, declared WHERE status = 'succeeded'""",
)
def _lineage_edges(spark, folder):
    """One row per run, output and upstream of every step of the runs that succeeded."""
    edges = F.array(*(
        F.struct(
            F.lit(s.key).alias("step_key"), F.lit(up).alias("upstream"), F.lit(down).alias("downstream")
        )
        for s in STEPS.values() for up, down in s.lineage()
    ))
    done = _runs(spark, folder).filter(F.col("status") == "succeeded")
    return done.select("run_id", F.explode(edges).alias("edge")).select("run_id", "edge.*")
