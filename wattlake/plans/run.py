"""Running the steps for one date or for many in one job."""

from __future__ import annotations

import time
from collections.abc import Callable, Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.plans.catalog import DATASETS, PHASES, PUBLISHED, STEPS, Step
from wattlake.plans.medallion import BUILD, Options
from wattlake.publish import Target, Warehouse
from wattlake.quality import Check, Expectation, QualityGateError, evaluate, gate
from wattlake.runlog import RunLog
from wattlake.sources.footers import unfit_files
from wattlake.sources.lake import Lake, new_attempt

#: How many days the rolling mean looks back beyond its own.
DAYS_BACK = 6
#: Landing files of a date up to which its raw rows are written as they are read.
FEW_FILES = 4

SUCCEEDED, FAILED, COMPENSATED, RUNNING = "succeeded", "failed", "compensated", "running"


@dataclass
class RunResult:
    run_id: str
    business_date: date
    status: str = RUNNING
    steps_succeeded: int = 0
    steps_failed: int = 0
    rows_published: int = 0
    published_tables: list[str] = field(default_factory=list)
    sla_breaches: list[str] = field(default_factory=list)
    error: str = ""


@dataclass
class BackfillResult:
    completed: list[date]
    failed: list[date]
    rows_published: int
    runs: dict[date, RunResult]


def dates_between(start: date, end: date) -> list[date]:
    """Both ends included."""
    if end < start:
        raise ValueError(f"end date {end} is before start date {start}")
    return [start + timedelta(days=i) for i in range((end - start).days + 1)]


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Engine:
    """Steps over a lake, published to a warehouse, recorded in logs.

    Data passes between steps as files: the gate has to see what was written,
    a lost executor cannot take finished steps with it, and a failed run leaves
    its evidence. Each call is an attempt with folders of its own, so what is published
    stays as it was until a later attempt has passed every gate. The driver only handles
    counts, paths and check results.
    """

    def __init__(
        self, spark: SparkSession, lake_root: str, warehouse_root: str, options: Options = Options(),
        steps: Mapping[str, Step] = STEPS,
    ):
        self.spark = spark
        self.lake = Lake(spark, lake_root)
        self.warehouse = Warehouse(spark, warehouse_root)
        self.log = RunLog(spark, warehouse_root)
        self.options = options
        self.steps = steps

    # -- public ------------------------------------------------------------

    def run_date(
        self, day: date, run_id: str, *, publish: bool = True,
        after_publish: Callable[[], None] | None = None,
    ) -> RunResult:
        """All steps for one date. A failed ERROR check stops the run before publishing.

        Whatever fails, also ``after_publish``, takes back what this run had
        published, is recorded, and is raised.
        """
        state = self._begin({day: run_id})
        try:
            self._steps(state)
            error = state.errors.get(day)
            if error is not None:
                raise error
            if publish:
                self._publish(state)
                if after_publish is not None:
                    after_publish()
        except Exception as error:
            result = state.results[day]
            result.status = FAILED
            result.error = f"{type(error).__name__}: {error}"
            self.warehouse.restore(run_id, day, result.error)
            result.status = COMPENSATED
            self._finish(state)
            raise
        state.results[day].status = SUCCEEDED
        self._finish(state)
        return state.results[day]

    def backfill(
        self, start: date, end: date, completed: Sequence[date] = (), *, prefix: str = "backfill-",
    ) -> BackfillResult:
        """All dates of a range in one job per step, each date with its own run id and gate.

        A date that fails a gate drops out of the later steps; the others go on
        and are published together. Dates already completed are skipped.
        """
        days = [d for d in dates_between(start, end) if d not in set(completed)]
        done = self.run_dates(days, prefix)
        return replace(done, completed=[*completed, *done.completed])

    def run_dates(self, days: Sequence[date], prefix: str) -> BackfillResult:
        """The given dates in one job per step; run ids are the prefix and the date.

        If a job fails, the footers of the dates' landing files are read, and the dates whose files are damaged or
        store a column as another type fail. If that is not the cause, the dates are halved and tried again until those that make it fail are alone; they
        are recorded as failed and the others go on. A date that fails after it was published is taken back.
        """
        if not days:
            return BackfillResult([], [], 0, {})
        days = sorted(days)
        state = self._begin({d: f"{prefix}{d.isoformat()}" for d in days})
        try:
            self._steps(state)
            self._publish(state)
        except Exception as error:
            runs = {day: result.run_id for day, result in state.results.items()}
            for event in self.warehouse.restore_many(runs, f"{type(error).__name__}: {error}").events:
                state.results[event.business_date].status = COMPENSATED
            unfit = self._unfit(days) if len(days) > 1 else {}
            if unfit:  # one job has named all dates whose files can't be read; the others go on together
                for day, reason in unfit.items():
                    state.fail(day, ValueError(reason))
                self._finish(state.only(unfit))
                failed = BackfillResult([], sorted(unfit), 0, {d: state.results[d] for d in unfit})
                return _merged([failed, self.run_dates([d for d in days if d not in unfit], prefix)])
            if len(days) > 1:
                half = len(days) // 2
                return _merged([self.run_dates(days[:half], prefix), self.run_dates(days[half:], prefix)])
            state.fail(days[0], error)
        for day, result in state.results.items():
            if result.status != COMPENSATED:
                result.status = FAILED if day in state.errors else SUCCEEDED
        self._finish(state)
        return BackfillResult(
            list(state.alive), sorted(state.errors),
            sum(r.rows_published for r in state.results.values()), state.results,
        )

    def _unfit(self, days: Sequence[date]) -> dict[date, str]:
        """Why the landing files of which dates can't be read, from their footers."""
        found: dict[date, str] = {}
        for name in {n for s in self.steps.values() for n in s.inputs}:
            dataset = DATASETS[name]
            if dataset.layer != "landing" or not dataset.dated or dataset.fmt != "parquet":
                continue
            base = self.lake.dataset_path(dataset)
            there = sorted(set(days) - set(self.lake.missing(name, days)))
            if there:
                bad = unfit_files(self.spark, [f"{base}/dt={d.isoformat()}" for d in there], dataset.schema)
                day = F.to_date(F.regexp_extract("path", r"/dt=(\d{4}-\d{2}-\d{2})/", 1)).alias("day")
                rows = bad.groupBy(day).agg(F.min(F.concat_ws(": ", "path", "reason")).alias("reason")).collect()
                found |= {r.day: f"{name}: {r.reason}" for r in rows}
        return found

    # -- steps -------------------------------------------------------------

    def _begin(self, runs: Mapping[date, str]) -> _Progress:
        state = _Progress(runs, self.lake.bound(new_attempt()))
        self._start(state)
        return state

    def _steps(self, state: _Progress) -> None:
        for name in {n for s in self.steps.values() for n in s.inputs if DATASETS[n].layer == "landing" and DATASETS[n].dated}:
            for day in self.lake.missing(name, list(state.alive)):
                state.fail(day, FileNotFoundError(f"{name} has no files of {day}"))
        for _, keys in PHASES:
            if not state.alive:
                return
            # Independent steps of small inputs: let their jobs share the cluster.
            with ThreadPoolExecutor(max_workers=len(keys)) as pool:
                outcomes = list(pool.map(lambda key: self._step(self.steps[key], state), keys))
            for outcome in outcomes:
                self._settle(outcome, state)

    def _step(self, step: Step, state: _Progress) -> _Outcome:
        started = time.monotonic()
        days = dict(state.alive)
        frames = {name: self._input(name, days, state) for name in step.inputs} | self._looked_back_at(step, days)
        rows = BUILD[step.key](frames, replace(self.options, dates=(min(days), max(days))))
        placed_at = days if step.per_date else dict([next(iter(days.items()))])
        self._write(step, rows, placed_at, state.lake)
        state.dimension_runs.update({name: placed_at for name in step.outputs if not step.per_date})
        seconds = round(time.monotonic() - started, 3)

        written = {name: self._written(name, days, state) for name in step.outputs}
        seen = {e.dataset for e in step.expectations}
        seen |= {v for e in step.expectations for k, v in e.params.items() if k in ("against", "parent")}
        known = written | {n: self._written(n, days, state) for n in seen - set(written)}
        counted = [n for n in (*step.outputs, *step.inputs)]
        known |= {n: self._counted_input(n, days, state) for n in step.inputs if n not in known}
        # Row counts ride along with the checks: one action for both.
        counts = [Expectation("row_count_min", n, params={"min": 0}) for n in counted]
        # With one date there is nothing to tell apart, and the aggregates need no key.
        by = "dt" if len(days) > 1 else None
        # What is published must be of its own date; over many dates the folders follow from it.
        published = [n for n in step.outputs if n in PUBLISHED] if by is None else []
        own = [
            Expectation("between", n, "business_date", {"min": min(days), "max": max(days)}, name=f"own_date:{n}")
            for n in published
        ]
        checks = evaluate([*step.expectations, *own, *counts], known, by=by, groups=list(days))
        split = len(step.expectations) * len(days)
        strangers = [c for c in checks[split:split + len(own)] if not c.passed]
        rows_of = {(c.dataset, c.group): int(c.observed) for c in checks[split + len(own):] if c.observed}
        return _Outcome(step, days, seconds, checks[:split] + strangers, rows_of)

    def _input(self, name: str, days: Mapping[date, str], state: _Progress) -> DataFrame:
        if DATASETS[name].layer == "landing":
            return state.lake.landing(name, list(days))
        keep_dt = name == "bronze_weather"
        return state.lake.read(name, state.dimension_runs.get(name, days), keep_dt=keep_dt)

    def _looked_back_at(self, step: Step, days: Mapping[date, str]) -> dict[str, DataFrame]:
        """What the history scope needs of dates outside this run: readings of days before, published totals."""
        if self.options.scope != "history":
            return {}
        if step.key == "silver_cleanse":
            before = {d - timedelta(days=1) for d in days} - set(days)
            there = sorted(before - set(self.lake.missing("landing_readings", sorted(before))))
            if there:
                raw = {"landing_readings": self.lake.landing("landing_readings", there)}
                return {"day_before": BUILD["bronze_readings"](raw, self.options)}
        table = PUBLISHED.get(step.key)
        if step.key == "gold_daily_region" and table in self.warehouse.tables():
            on = F.col("business_date")
            window = on.between(min(days) - timedelta(days=DAYS_BACK), max(days)) & ~on.isin(list(days))
            return {"earlier_days": self.warehouse.table(table).filter(window)}
        return {}

    def touched(self, days: Sequence[date]) -> list[date]:
        """The dates, and in the history scope the published ones whose figures look back at them."""
        if self.options.scope != "history":
            return sorted(days)
        table = PUBLISHED["gold_daily_region"]
        known = {p.business_date for p in self.warehouse.pointers().filter(F.col("table_name") == table).collect()}
        later = {d + timedelta(days=n) for d in days for n in range(1, DAYS_BACK + 1)}
        return sorted(set(days) | (later & known))

    def _counted_input(self, name: str, days: Mapping[date, str], state: _Progress) -> DataFrame:
        if DATASETS[name].layer == "landing":
            return state.lake.landing(name, list(days))
        return self._written(name, days, state)

    def _written(self, name: str, days: Mapping[date, str], state: _Progress) -> DataFrame:
        """A written dataset for checking: split by ``dt`` unless it is the same on every date."""
        if name in state.dimension_runs:
            return state.lake.read(name, state.dimension_runs[name])
        return state.lake.read(name, days, keep_dt=True)

    def _write(self, step: Step, rows: DataFrame, days: Mapping[date, str], lake: Lake) -> None:
        dataset = F.col("dataset") if len(step.outputs) > 1 else step.outputs[0]
        if len(days) == 1:
            (day, run), = days.items()
            dt, run_of = F.lit(day), F.lit(run)
            if len(step.outputs) == 1:
                lake.write_one(step.outputs[0], rows.drop("dt"), day, run)
                return
        else:
            dt = F.col("dt") if "dt" in rows.columns else F.col("business_date")
            prefix = next(iter(days.values())).removesuffix(next(iter(days)).isoformat())
            run_of = F.concat(F.lit(prefix), dt.cast("string"))
        lake.write(step.layer, rows, dataset, dt, run_of, many_dates=len(days) > 1 and not _by_date(step, rows, days))

    def _settle(self, outcome: _Outcome, state: _Progress) -> None:
        """Record a finished step per date and drop the dates whose gate did not pass."""
        step, metrics, results, lineage = outcome.step, [], [], []
        for day, run in outcome.days.items():
            checks = [c for c in outcome.checks if c.group == day]
            error = None
            try:
                gate(step.key, checks)
            except QualityGateError as found:
                error = found
            failed = error is not None
            breached = outcome.seconds > step.sla_seconds
            result = state.results[day]
            result.steps_failed += failed
            result.steps_succeeded += not failed
            if breached:
                result.sla_breaches.append(f"{step.key} over {step.sla_seconds}s")
            if error is not None:
                state.fail(day, error)
            placed = state.dimension_runs.get(step.outputs[0], outcome.days)
            where = (day, run) if day in placed else next(iter(placed.items()))
            uri = state.lake.path(step.outputs[0], *where)
            metrics.append({
                "run_id": run, "step_key": step.key, "layer": step.layer,
                "state": FAILED if failed else SUCCEEDED, "attempts": 1,
                "rows_in": sum(outcome.rows.get((n, day), 0) for n in step.inputs),
                "rows_out": outcome.rows.get((step.outputs[0], day), 0),
                "rows_rejected": sum(outcome.rows.get((n, day), 0) for n in step.outputs[1:]),
                "duration_seconds": outcome.seconds, "bytes_out": state.lake.bytes(step.outputs[0], *where),
                "threads": self.spark.sparkContext.defaultParallelism, "memory_limit": "",
                "sla_seconds": step.sla_seconds, "sla_breached": breached,
                "output_uri": uri, "error": str(error or ""),
            })
            results += [
                {"run_id": run, "step_key": step.key, "check_name": c.name, "kind": c.kind,
                 "dataset": c.dataset, "column_name": c.column, "severity": c.severity,
                 "passed": c.passed, "observed": c.observed, "expected": c.expected, "detail": c.detail}
                for c in checks
            ]
            if not failed:
                lineage += [
                    {"run_id": run, "step_key": step.key, "upstream": up, "downstream": down, "columns": ""}
                    for up, down in step.lineage()
                ]
        state.rows.update(outcome.rows)
        state.pending["step_metrics"] += metrics
        state.pending["dq_results"] += results
        state.pending["lineage"] += lineage

    # -- publish and records -------------------------------------------------

    def _publish(self, state: _Progress) -> None:
        items = [
            (run, Target(table, state.lake.path(name, day, run), day,
                         state.rows.get((name, day)), DATASETS[name].schema))
            for day, run in state.alive.items()
            for name, table in PUBLISHED.items()
        ]
        for event in self.warehouse.publish_many(items).events:
            result = state.results[event.business_date]
            result.rows_published += event.rows_written
            result.published_tables.append(event.table_name)

    def _start(self, state: _Progress) -> None:
        self.log.append({"runs": [self._run_row(r, state) for r in state.results.values()]})

    def _finish(self, state: _Progress) -> None:
        finished = _now()
        rows = [self._run_row(r, state) | {"finished_at": finished} for r in state.results.values()]
        self.log.append({**state.pending, "runs": rows})

    def _run_row(self, result: RunResult, state: _Progress) -> dict:
        return {
            "run_id": result.run_id, "workflow_id": result.run_id, "business_date": result.business_date,
            "mode": "auto", "status": result.status, "started_at": state.started,
            "rows_published": result.rows_published, "error": result.error,
        }


def _by_date(step: Step, rows: DataFrame, days: Mapping[date, str]) -> bool:
    """Whether the rows come as a few files a date, so that each task has few dates and need not be dealt them.

    Raw rows are changed one by one, so a task writes no more files than it has read. Many small files are gathered.
    """
    return step.layer == "bronze" and step.per_date and len(rows.inputFiles()) <= FEW_FILES * len(days)


class _Progress:
    """Dates still going, with their run ids, and what has been found out about each."""

    def __init__(self, runs: Mapping[date, str], lake: Lake):
        self.lake = lake
        self.alive = dict(runs)
        self.started = _now()
        self.results = {d: RunResult(run, d) for d, run in runs.items()}
        self.errors: dict[date, Exception] = {}
        self.dimension_runs: dict[str, Mapping[date, str]] = {}
        self.rows: dict[tuple[str, date], int] = {}
        self.pending: dict[str, list] = {"step_metrics": [], "dq_results": [], "lineage": []}

    def only(self, days: Collection[date]) -> _Progress:
        """The same of some dates, with nothing else to record."""
        part = _Progress({}, self.lake)
        part.started, part.results = self.started, {d: self.results[d] for d in days}
        return part

    def fail(self, day: date, error: Exception) -> None:
        self.alive.pop(day, None)
        self.errors.setdefault(day, error)
        self.results[day].status = FAILED
        self.results[day].error = f"{type(error).__name__}: {error}"


def _merged(parts: Sequence[BackfillResult]) -> BackfillResult:
    runs = {d: r for p in parts for d, r in p.runs.items()}
    return BackfillResult(
        [d for p in parts for d in p.completed], [d for p in parts for d in p.failed],
        sum(p.rows_published for p in parts), runs,
    )


@dataclass(frozen=True)
class _Outcome:
    step: Step
    days: Mapping[date, str]
    seconds: float
    checks: list[Check]
    rows: Mapping[tuple[str, date], int]
