"""Keeping published dates right while readings still arrive.

A stream watches the landing folder. Each micro-batch only tells which dates got
new files; those dates are then run again in one batch job over everything they
have, so late, repeated and out-of-order readings end up as in a full reprocess:
window functions and group figures of a date need all of it anyway.

Where figures look back over days (``scope="history"``), the published dates that
look back at a changed one are run again with it.

The batch number is part of the run id. A batch that is delivered twice repeats
the same runs as new attempts, which publish the same rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattlake.operators.changes import changed_intervals, touched_dates
from wattlake.plans.catalog import DATASETS
from wattlake.plans.run import BackfillResult, Engine

#: Key and time of the dimensions; a meter is in force always.
_IN_FORCE = {"landing_tariffs": (["tariff_plan"], "valid_from"), "landing_weather": (["region"], "ts"), "landing_meters": (["meter_id"], None)}


def process_arrivals(
    engine: Engine, checkpoint: str, *, max_files: int = 1_000, available_now: bool = True,
) -> StreamingQuery:
    """Start the stream. With ``available_now`` it stops once the present files are dealt with.

    Dates that fail a gate keep what was published before and are recorded as failed.
    """
    readings = DATASETS["landing_readings"]
    arrivals = (
        engine.spark.readStream.schema(f"{readings.schema}, dt date")
        .option("maxFilesPerTrigger", max_files)
        .parquet(engine.lake.dataset_path(readings))
    )

    def rerun(batch: DataFrame, batch_id: int) -> None:
        # Dates come from the folder names; no column of the files is read.
        days = [r.dt for r in batch.select("dt").distinct().collect()]
        engine.run_dates(engine.touched(days), prefix=f"arrivals-{batch_id}-")

    writer = arrivals.writeStream.foreachBatch(rerun).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def process_changed_dimension(engine: Engine, name: str, old: DataFrame, *, prefix: str) -> BackfillResult:
    """Run the published dates again that a changed row of a dimension was in force on, and no others.

    ``old`` is the landing dataset ``name`` as it was when they were published; the landing folder has the new
    one. A changed observation counts on its own date, a changed meter on all dates. With nothing changed,
    nothing is run.
    """
    keys, time = _IN_FORCE[name]
    published = sorted({p.business_date for p in engine.warehouse.pointers().select("business_date").distinct().collect()})
    if not published:
        return engine.run_dates([], prefix)
    dated = DATASETS[name].dated
    days = [d for d in published if d not in set(engine.lake.missing(name, published))] if dated else []
    new = engine.lake.landing(name, days)
    if dated:
        changed = changed_intervals(old.filter(F.col("dt").isin(published)), new, [*keys, "dt"], time)
        touched = changed.select(F.col("dt").alias("touched")).distinct()
    else:
        touched = touched_dates(changed_intervals(old, new, keys, time), published[0], published[-1])
    found = {r.touched for r in touched.filter(F.col("touched").isin(published)).collect()}  # at most the published dates
    return engine.run_dates(engine.touched(found), prefix) if found else engine.run_dates([], prefix)
