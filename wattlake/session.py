"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: Settings a stand-alone session gets. None of the operators depends on them for
#: its result; they are what a cluster would be started with as well.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Lets one task write the few partitions it holds without sorting by them first.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = "*", app_name: str = "wattlake", **conf: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would lose the data with the machine that holds it.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None)
    current = context.getCheckpointDir()
    if named is None and current is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a shared folder")
        named = tempfile.mkdtemp(prefix="wattlake-")
    if current is None:
        context.setCheckpointDir(named)
        current = context.getCheckpointDir()
    return named or current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return os.path.join(ensure_checkpoint_dir(spark), "wattlake", f"{label}-{uuid.uuid4().hex}")


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage, so that several branches can read it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_ARROW = {
    "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(),
    "boolean": pa.bool_(), "date": pa.date32(), "timestamp_ntz": pa.timestamp("us"),
}


def small_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few driver-side records as a frame; handed over as Arrow, so it is a local relation."""
    columns = StructType.fromDDL(schema)
    arrow = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in columns.fields])
    full = [{name: row.get(name) for name in columns.names} for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(full, schema=arrow), columns)
