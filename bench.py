"""Times the headline queries and a full run; prints one JSON line.

    BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)

Every query is run once to warm up and then timed, to a sink that reads every
row and column. The run is the whole chain for one date of 20,000 synthetic
meters, 1.95 million readings: bronze, cleanse, enrich, gold, gates, publish.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "silver_readings silver_quarantine silver_enriched gold_daily_region gold_daily_region_history "
    "gold_meter_anomalies latest_per_key lag_difference classify_reject_reason dim_join asof_inner "
    "asof_left asof_large_right daily_group_filter lineitem_group duplicate_keys dense_rank_quantity "
    "partition_stats_zscore top_n_or_flag rolling_7d_range hourly_load_profile check_report run_rollup "
    "scalar_functions"
).split()
METERS = 20_000
DAY = date(2026, 8, 1)


def main() -> None:
    from wattlake.plans import load_queries
    from wattlake.plans.run import Engine
    from wattlake.session import local_session
    from wattlake.sources.synthetic import seed_landing

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = local_session(
        cpus, **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": f"{scratch}/checkpoints",
        }
    )
    queries, _ = load_queries()
    times: dict[str, float] = {}
    for name in HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - started, 3)

    seed_landing(spark, f"{scratch}/lake", [DAY], METERS)
    engine = Engine(spark, f"{scratch}/lake", f"{scratch}/warehouse")
    for attempt in range(3):
        started = time.perf_counter()
        result = engine.run_date(DAY, f"bench-{attempt}")
        elapsed = round(time.perf_counter() - started, 3)
    steps = {
        m.step_key: m
        for m in engine.log.table("step_metrics").filter("run_id = 'bench-2'").collect()
    }
    run = {f"run_{key}": round(m.duration_seconds, 3) for key, m in steps.items()}
    run["run_end_to_end"] = elapsed
    line = {
        "metric": "total seconds of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times | run,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "meters": METERS,
        "raw_readings": steps["bronze_readings"].rows_in,
        "rows_published": result.rows_published,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
