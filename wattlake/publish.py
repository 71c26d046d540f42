"""Publishing by pointer.

Gold files stay where a run wrote them. What readers see is decided by an
append-only log: the newest event of a table and date says which run's files
are current. Replacing a date, or restoring the run before, appends an event and
moves no data; several tables change together by being appended in one file.

One publisher at a time is assumed: plain files offer no compare-and-swap.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattlake.session import small_table
from wattlake.sources.files import exists

_EVENTS = (
    "seq bigint, event string, run_id string, table_name string, business_date date, source_uri string, "
    "rows_deleted bigint, rows_written bigint, previous_run_id string, previous_source_uri string, "
    "published_at timestamp_ntz, schema string"
)
PUBLISH, RESTORE = "publish", "restore"


@dataclass(frozen=True)
class Target:
    """Files to publish. A caller that wrote and counted them can say so, which spares a look."""

    table: str
    source_uri: str
    business_date: date
    rows: int | None = None
    schema: str | None = None


@dataclass(frozen=True)
class Event:
    """A change of the pointer of one table and date: a row of the log."""

    event: str
    run_id: str
    table_name: str
    business_date: date
    source_uri: str
    rows_deleted: int = 0
    rows_written: int = 0
    previous_run_id: str = ""
    previous_source_uri: str = ""
    schema: str | None = None

    @property
    def place(self) -> str:
        return f"{self.table_name}@{self.business_date}"


@dataclass(frozen=True)
class Changes:
    """The events that one call appended, and why."""

    events: tuple[Event, ...] = ()
    reason: str = ""

    @property
    def total_rows(self) -> int:
        return sum(e.rows_written for e in self.events)

    @property
    def restored(self) -> list[str]:
        """Places that point at an earlier run again."""
        return [f"{e.place}->run {e.previous_run_id}" for e in self.events if e.event == RESTORE and e.previous_source_uri]

    @property
    def deleted(self) -> list[str]:
        """Places that had no earlier run."""
        return [e.place for e in self.events if e.event == RESTORE and not e.previous_source_uri]

    @property
    def note(self) -> str:
        return self.reason if self.events else f"{self.reason}: no publish of this run stands"


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Warehouse:
    """Published tables below ``root``, each keyed by ``business_date``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._log = f"{self.root}/meta/publish_events"

    # -- the log -----------------------------------------------------------

    def events(self) -> DataFrame:
        if not exists(self.spark, self._log):
            return self.spark.createDataFrame([], _EVENTS)
        return self.spark.read.schema(_EVENTS).parquet(self._log)

    def _append(self, events: Sequence[Event], after: int) -> None:
        """One file, so that all events appear together or not at all; they are numbered on."""
        at = _now()
        rows = [vars(e) | {"seq": after + n, "published_at": at} for n, e in enumerate(events, start=1)]
        small_table(self.spark, rows, _EVENTS).coalesce(1).write.mode("append").parquet(self._log)

    def publish_log(self) -> DataFrame:
        """One row per run, table and date: its last publish, and whether it was undone since."""
        last = F.max_by(F.struct("*"), F.when(F.col("event") == PUBLISH, F.col("seq")))
        undone = F.max(F.when(F.col("event") == RESTORE, F.col("seq")))
        return (
            self.events().groupBy("run_id", "table_name", "business_date")
            .agg(last.alias("p"), undone.alias("undone"))
            .select(
                "run_id", "table_name", "business_date", "p.source_uri", "p.rows_deleted",
                "p.rows_written", "p.previous_run_id", "p.previous_source_uri", "p.published_at",
                F.coalesce(F.col("undone") > F.col("p.seq"), F.lit(False)).alias("compensated"),
                "p.seq",
            )
        )

    def pointers(self) -> DataFrame:
        """Per table and date the run and files in force; a date that was taken back has none."""
        published = F.col("event") == PUBLISH
        newest = self.events().groupBy("table_name", "business_date").agg(
            F.max_by(
                F.struct(
                    F.when(published, F.col("run_id")).otherwise(F.col("previous_run_id")).alias("run_id"),
                    F.when(published, F.col("source_uri")).otherwise(F.col("previous_source_uri"))
                    .alias("source_uri"),
                ),
                "seq",
            ).alias("at")
        )
        return newest.select("table_name", "business_date", "at.*").filter("source_uri <> ''")

    # -- publish and restore -----------------------------------------------

    def publish(self, run_id: str, targets: Sequence[Target]) -> Changes:
        """Make these files the current ones of their dates, all in one append.

        Publishing again by the same run changes nothing: a run is not its own
        predecessor. A source must have rows of its own date only.
        """
        return self.publish_many([(run_id, t) for t in targets])

    def publish_many(self, items: Sequence[tuple[str, Target]]) -> Changes:
        """Like ``publish``, for targets of several runs."""
        if not items:
            return Changes()
        past, schemas, seq = self._state({t.business_date for _, t in items})
        rows = self._count_rows([t for _, t in items], schemas)
        events = []
        for run_id, target in items:
            of_date = past.get((target.table, target.business_date), [])
            before, current = _owner(of_date, other_than=run_id), _current(of_date)
            events.append(Event(
                PUBLISH, run_id, target.table, target.business_date, target.source_uri,
                rows_deleted=current.rows_written if current else 0, rows_written=rows[target.source_uri],
                previous_run_id=before.run_id if before else "",
                previous_source_uri=before.source_uri if before else "",
                schema=schemas[target.table].json(),
            ))
        self._append(events, seq)
        return Changes(tuple(events))

    def restore(self, run_id: str, business_date: date, reason: str) -> Changes:
        """Undo what a run published: point back at the files recorded as its predecessor,
        or leave the date absent if there was none. A second call finds nothing to do."""
        return self.restore_many({business_date: run_id}, reason)

    def restore_many(self, runs: Mapping[date, str], reason: str) -> Changes:
        """Like ``restore``, for the run of each date: one read of the log and one append."""
        past, _, seq = self._state(set(runs))
        standing = [e for of_date in past.values() for e in _standing(of_date) if e.run_id == runs[e.business_date]]
        events = [
            Event(
                RESTORE, e.run_id, e.table_name, e.business_date, e.source_uri,
                previous_run_id=e.previous_run_id, previous_source_uri=e.previous_source_uri,
            )
            for e in sorted(standing, key=lambda e: e.seq)
        ]
        if events:
            self._append(events, seq)
        return Changes(tuple(events), reason)

    def _state(self, days: set[date]) -> tuple[dict[tuple[str, date], list[Row]], dict[str, StructType], int]:
        """From one read of the log: events of a few dates by table and date, oldest first, tables' columns, the last number.

        A handful of events per publish of these dates reach the driver, and a line per table.
        """
        log = self.events()
        mine = F.when(F.col("business_date").isin(list(days)), F.struct(*(c for c in log.columns if c != "schema")))
        state = log.groupBy("table_name").agg(
            F.min_by("schema", F.when(F.col("event") == PUBLISH, F.col("seq"))).alias("schema"),
            F.max("seq").alias("seq"), F.collect_list(mine).alias("events"),
        ).collect()
        past: dict[tuple[str, date], list[Row]] = {}
        for e in sorted((e for r in state for e in r.events), key=lambda e: e.seq):
            past.setdefault((e.table_name, e.business_date), []).append(e)
        schemas = {r.table_name: StructType.fromJson(json.loads(r.schema)) for r in state if r.schema}
        return past, schemas, max((r.seq for r in state), default=0)

    # -- reading -----------------------------------------------------------

    def tables(self) -> list[str]:
        return sorted(self._schemas())

    def table(self, name: str) -> DataFrame:
        """The current rows of a table.

        Pointers, one per date, become the very paths to read; runs that were
        replaced are not even listed.
        """
        schema = self._schemas()[name]
        paths = [p.source_uri for p in self.pointers().filter(F.col("table_name") == name).collect()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def register_views(self) -> None:
        """Expose every table by its last name part, for SQL."""
        for name in self.tables():
            self.table(name).createOrReplaceTempView(name.rsplit(".", 1)[-1])

    def _schemas(self) -> dict[str, StructType]:
        """A table keeps the columns of its first publish."""
        first = self.events().groupBy("table_name").agg(
            F.min_by("schema", F.when(F.col("event") == PUBLISH, F.col("seq"))).alias("schema")
        )
        return {r.table_name: StructType.fromJson(json.loads(r.schema)) for r in first.collect()}

    def _count_rows(self, targets: Sequence[Target], schemas: dict[str, StructType]) -> dict[str, int]:
        """Rows of each source; one job per table, reading only the date column.

        Columns are matched by name: one that is missing reads as NULL, an unknown
        one is an error, as is a column whose type changed.
        """
        counts: dict[str, int] = {}
        for name in dict.fromkeys(t.table for t in targets):
            mine = [t for t in targets if t.table == name]
            if all(t.schema is not None and t.rows is not None for t in mine):
                offered = StructType.fromDDL(mine[0].schema)
            else:
                offered = self.spark.read.option("mergeSchema", True).parquet(*(t.source_uri for t in mine)).schema
            known = schemas.setdefault(name, offered)
            for f in offered.fields:
                if f.name not in known.names:
                    raise ValueError(f"{name} has no column {f.name!r}")
                if known[f.name].dataType != f.dataType:
                    raise ValueError(f"{name}.{f.name} is {known[f.name].dataType.simpleString()}")
            counts |= {t.source_uri: t.rows for t in mine if t.rows is not None}
            expected = {t.source_uri: t.business_date for t in mine if t.rows is None}
            if not expected:
                continue
            found = (
                self.spark.read.schema(known).parquet(*expected)
                .select("business_date", F.regexp_replace("_metadata.file_path", "/[^/]+$", "").alias("folder"))
                .groupBy("folder", "business_date").agg(F.count(F.lit(1)).alias("n")).collect()
            )
            for uri, day in expected.items():
                # Spark reports folders with a scheme, so compare by their end.
                inside = [r for r in found if r.folder.endswith(_bare(uri))]
                if any(r.business_date != day for r in inside):
                    raise ValueError(f"{uri} has rows of other dates than {day}")
                counts[uri] = sum(r.n for r in inside)
        return counts


def _standing(events: Sequence[Row]) -> list[Row]:
    """Publishes not undone, one per run, table and date, oldest first."""
    latest: dict[tuple, Row] = {}
    for e in events:
        key = (e.run_id, e.table_name, e.business_date)
        latest.pop(key, None)
        if e.event == PUBLISH:
            latest[key] = e
    return list(latest.values())


def _owner(events: Sequence[Row], other_than: str) -> Row | None:
    """The last run, other than this one, whose publish of the date stands."""
    others = [e for e in _standing(events) if e.run_id != other_than]
    return others[-1] if others else None


def _current(events: Sequence[Row]) -> Row | None:
    """The publish whose files are in force for one table and date."""
    if not events:
        return None
    uri = events[-1].source_uri if events[-1].event == PUBLISH else events[-1].previous_source_uri
    return next((e for e in reversed(events) if e.event == PUBLISH and e.source_uri == uri), None)


def _bare(uri: str) -> str:
    return "/" + uri.split("://", 1)[-1].split(":", 1)[-1].strip("/")
