"""Totals of event-time windows over a stream, each written once, when the watermark has passed its end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed_totals(
    stream: DataFrame, time: str, keys: Sequence[str], totals: dict[str, Column], *, width: str, delay: str, unique: Sequence[str] = (),
) -> DataFrame:
    """``window_start, window_end``, the keys and the totals of each window of ``width``.

    Rows later than ``delay`` behind the newest seen are left out. Rows that repeat the ``unique`` columns within
    that time count once. State holds the open windows of each key and the recent unique keys, both cleared by
    the watermark. A zone-less time is taken as UTC, whatever the session's zone, and so are the windows' ends. For
    append mode.
    """
    zoneless = dict(stream.dtypes)[time] == "timestamp_ntz"
    if zoneless:  # watermarks need instants
        stream = stream.withColumn(time, F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(time)).cast("timestamp"))
    timed = stream.withWatermark(time, delay)
    if unique:
        timed = timed.dropDuplicatesWithinWatermark(list(unique))
    grouped = timed.groupBy(F.window(time, width).alias("_w"), *keys)
    start, end = F.col("_w.start"), F.col("_w.end")
    if zoneless:
        start, end = (F.convert_timezone(F.current_timezone(), F.lit("UTC"), x.cast("timestamp_ntz")) for x in (start, end))
    return grouped.agg(*(c.alias(name) for name, c in totals.items())).select(
        start.alias("window_start"), end.alias("window_end"), *keys, *totals
    )


def append_closed(totals: DataFrame, path: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Write closed windows as files; with ``available_now`` it stops when the present files are dealt with."""
    writer = totals.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
