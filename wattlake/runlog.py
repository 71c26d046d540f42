"""Records of runs: append-only logs, read through views of the latest row per key.

Parquet tables take no updates. A record that changes is written again, and its
key's newest row counts; for a run, what it was started with stays as it was.
"""

from __future__ import annotations

import itertools
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from types import MappingProxyType
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.operators import latest_per_key
from wattlake.session import small_table
from wattlake.sources.files import exists

# Names, columns and keys of the metadata tables.
SCHEMAS = MappingProxyType({
    "runs": (
        "run_id string, workflow_id string, business_date date, mode string, status string, "
        "started_at timestamp_ntz, finished_at timestamp_ntz, rows_published bigint, error string"
    ),
    "step_metrics": (
        "run_id string, step_key string, layer string, state string, attempts int, rows_in bigint, "
        "rows_out bigint, rows_rejected bigint, duration_seconds double, bytes_out bigint, threads int, "
        "memory_limit string, sla_seconds int, sla_breached boolean, output_uri string, error string"
    ),
    "dq_results": (
        "run_id string, step_key string, check_name string, kind string, dataset string, "
        "column_name string, severity string, passed boolean, observed string, expected string, detail string"
    ),
    "lineage": "run_id string, step_key string, upstream string, downstream string, columns string",
})
KEYS = MappingProxyType({
    "runs": ("run_id",),
    "step_metrics": ("run_id", "step_key"),
    "dq_results": ("run_id", "step_key", "check_name"),
    "lineage": ("run_id", "step_key", "upstream", "downstream"),
})
#: Columns of a run that a later record changes.
RUN_UPDATES = ("status", "finished_at", "rows_published", "error")
# End of the fixed values.

_tick = itertools.count()


def latest_runs(log: DataFrame, seq: str = "seq") -> DataFrame:
    """One row per run: changing columns from its newest record, the others from its first."""
    kept = [c for c in log.columns if c not in (*RUN_UPDATES, "run_id", seq)]
    return (
        log.groupBy("run_id")
        .agg(
            F.min_by(F.struct(*kept), seq).alias("first"),
            F.max_by(F.struct(*RUN_UPDATES), seq).alias("last"),
        )
        .select("run_id", *(f"first.{c}" for c in kept), *(f"last.{c}" for c in RUN_UPDATES))
    )


class RunLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = f"{root.rstrip('/')}/meta"

    def append(self, records: Mapping[str, Sequence[Mapping[str, Any]]]) -> None:
        """Add records, given as ``{table: [row, ...]}``. The tables are written side by side."""
        filled = {table: rows for table, rows in records.items() if rows}
        if not filled:
            return
        with ThreadPoolExecutor(max_workers=len(filled)) as pool:
            list(pool.map(lambda item: self._append(*item), filled.items()))

    def _append(self, table: str, rows: Sequence[Mapping[str, Any]]) -> None:
        stamped = [dict(row) | {"seq": time.time_ns() + next(_tick)} for row in rows]
        small_table(self.spark, stamped, f"{SCHEMAS[table]}, seq bigint").write.mode("append").parquet(
            f"{self.root}/{table}"
        )

    def log(self, table: str) -> DataFrame:
        schema = f"{SCHEMAS[table]}, seq bigint"
        path = f"{self.root}/{table}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def table(self, name: str) -> DataFrame:
        if name == "runs":
            columns = [c.split()[0] for c in SCHEMAS["runs"].split(", ")]
            return latest_runs(self.log("runs")).select(*columns)
        return latest_per_key(self.log(name), KEYS[name], "seq").drop("seq")

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in SCHEMAS}
