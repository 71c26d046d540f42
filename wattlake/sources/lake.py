"""Where datasets live, and how they are read and written.

    <root>/landing/<dataset>/[dt=<date>/]                        input, no run
    <root>/<layer>/dataset=<dataset>/dt=<date>/run=<run>/attempt=<attempt>/*.parquet

Every attempt of a run writes to folders of its own, so nothing that was written is ever
changed, also not by the same run. ``dataset``, ``dt``, ``run`` and ``attempt`` are
partition columns, so a single job can fill several datasets and dates, and a read
touches only the folders it names.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from wattlake.plans.catalog import DATASETS, Dataset
from wattlake.sources.files import children, exists, folder_bytes

#: Column types that only the path knows; declared, because inference turns run 007 into 7.
_PATH_COLUMNS = "dt date, run string, attempt string"
#: Size of the row groups of written files.
ROW_GROUP_BYTES = 128 << 20
FILE_OPTIONS = {"compression": "zstd", "parquet.block.size": str(ROW_GROUP_BYTES)}


def read_source(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet", schema: str | None = None):
    """A Parquet or CSV path as a frame; columns are matched by name.

    Give a schema where one is known. Without it, Parquet merges the schemas of
    all files and CSV types are inferred from the whole file, an extra pass.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "csv":
        rows = spark.read.option("header", True).csv(paths, inferSchema=schema is None)
        if schema is None:
            # Times without a zone stay as they are written.
            return rows.select(*(
                F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType == TimestampType() else F.col(f.name)
                for f in rows.schema.fields
            ))
        types = StructType.fromDDL(schema)
        return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in types.fields))
    if schema is None:
        return spark.read.option("mergeSchema", True).parquet(*paths)
    return spark.read.schema(schema).parquet(*paths)


def register_source(spark: SparkSession, name: str, path: str, fmt: str = "parquet", schema: str | None = None):
    """Make a path queryable under a plain name."""
    frame = read_source(spark, path, fmt, schema)
    frame.createOrReplaceTempView(name)
    return frame


def query(spark: SparkSession, sql: str, limit: int | None = None) -> DataFrame:
    """Ad-hoc read-only SQL, with a row cap if one is given. Used as a subquery, so statements that write do not parse."""
    rows = spark.sql(f"SELECT * FROM (\n{sql.rstrip().rstrip(';')}\n)")
    return rows if limit is None else rows.limit(limit)


def new_attempt() -> str:
    """A name that no other attempt has; later ones sort behind earlier ones."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


@dataclass(frozen=True)
class Written:
    """The receipt of a write."""

    rows: int


class Lake:
    """Datasets below ``root``; with an attempt, reads and writes are those of this attempt."""

    def __init__(self, spark: SparkSession, root: str, attempt: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.attempt = attempt
        self._bytes: dict[str, int] = {}

    def bound(self, attempt: str) -> Lake:
        return Lake(self.spark, self.root, attempt)

    def dataset_path(self, dataset: Dataset) -> str:
        if dataset.layer == "landing":
            return f"{self.root}/landing/{dataset.name}"
        return f"{self.root}/{dataset.layer}/dataset={dataset.name}"

    def path(self, name: str, day: date, run: str) -> str:
        """Folder of one dataset, date and run: of this attempt, or without one of the newest."""
        of_run = f"{self.dataset_path(DATASETS[name])}/dt={day.isoformat()}/run={run}"
        if self.attempt is not None:
            return f"{of_run}/attempt={self.attempt}"
        return f"{of_run}/{max(children(self.spark, of_run), default='attempt=')}"

    def missing(self, name: str, days: Sequence[date]) -> list[date]:
        """Dates for which a landing dataset has no folder."""
        there = children(self.spark, self.dataset_path(DATASETS[name]))
        return [d for d in days if f"dt={d.isoformat()}" not in there]

    def landing(self, name: str, days: Sequence[date]) -> DataFrame:
        """Raw input; a dated one has the column ``dt`` and only the given dates, all of which must be there."""
        dataset = DATASETS[name]
        base = self.dataset_path(dataset)
        if not dataset.dated:
            return read_source(self.spark, base, dataset.fmt, dataset.schema)
        return self._read([f"{base}/dt={d.isoformat()}" for d in days], base, f"{dataset.schema}, dt date")

    def read(self, name: str, runs: Mapping[date, str], *, keep_dt: bool = False) -> DataFrame:
        """The given run of each date. Columns are those of the catalog, plus ``dt`` if kept.

        A date for which the run wrote no row of the dataset has none.
        """
        dataset = DATASETS[name]
        paths = [self.path(name, d, run) for d, run in runs.items()]
        found = [p for p in paths if self._bytes_in(p) is not None]
        frame = self._read(found, self.dataset_path(dataset), f"{dataset.schema}, {_PATH_COLUMNS}")
        return frame.drop("run", "attempt") if keep_dt else frame.drop("run", "attempt", "dt")

    def history(self, name: str) -> DataFrame:
        """Everything that was ever written to the dataset, with ``dt``, ``run`` and ``attempt`` as columns."""
        dataset = DATASETS[name]
        base = self.dataset_path(dataset)
        found = [base] if exists(self.spark, base) else []
        return self._read(found, base, f"{dataset.schema}, {_PATH_COLUMNS}")

    def write(
        self, layer: str, rows: DataFrame, dataset: str | Column, dt: Column, run: Column, many_dates: bool
    ) -> Written:
        """Add rows to the folders that their dataset, date and run call for, in this attempt.

        Nothing is replaced. Jobs that add to one folder at a time would clear each other's unfinished
        files, so steps that run side by side name their one dataset and write below it. Over many dates the rows are first gathered by date, in pieces of a
        reasonable size, or every task would add a file to every date. Row groups are of ROW_GROUP_BYTES
        whatever the session says. The receipt's count is taken while the rows are written.
        """
        placed = rows.withColumns({"dt": dt, "run": run, "attempt": F.lit(self._own_attempt())})
        if isinstance(dataset, str):
            by, target = ["dt", "run", "attempt"], self.dataset_path(DATASETS[dataset])
            placed = placed.drop("dataset")
        else:
            by, target = ["dataset", "dt", "run", "attempt"], f"{self.root}/{layer}"
            placed = placed.withColumn("dataset", dataset)
        if many_dates:
            placed = placed.hint("rebalance", *by[:-2])
        observed = Observation()
        (
            placed.observe(observed, F.count(F.lit(1)).alias("n"))
            .write.mode("append").options(**FILE_OPTIONS).partitionBy(*by).parquet(target)
        )
        return Written(observed.get["n"])

    def write_one(self, name: str, rows: DataFrame, day: date, run: str) -> Written:
        """Write rows of one dataset and date straight into their folder."""
        observed, lake = Observation(), self.bound(self._own_attempt())
        rows.observe(observed, F.count(F.lit(1)).alias("n")).write.options(**FILE_OPTIONS).parquet(lake.path(name, day, run))
        return Written(observed.get["n"])

    def bytes(self, name: str, day: date, run: str) -> int:
        return self._bytes_in(self.path(name, day, run)) or 0

    def _own_attempt(self) -> str:
        """The attempt that is bound, or one for a single write."""
        return self.attempt or new_attempt()

    def _bytes_in(self, path: str) -> int | None:
        """Bytes of one folder, None if there is none. What an attempt wrote is listed once, and nothing beside it."""
        known = self._bytes.get(path)
        if known is None:
            known = folder_bytes(self.spark, path)
            if known is not None and self.attempt is not None:
                self._bytes[path] = known
        return known

    def _read(self, paths: list[str], base: str, schema: str) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", base).schema(schema).parquet(*paths)

