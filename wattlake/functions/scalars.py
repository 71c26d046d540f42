"""Scalar expressions whose exact value matters; all of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: From here on a double has no fraction left to round.
_NO_FRACTION = 2.0**52


def round_to(value: Column, digits: int) -> Column:
    """Round a double half away from zero on its binary value.

    Spark's ``round(x, n)`` rounds the decimal text of ``x`` (1.005 -> 1.01).
    Analytical databases scale, round and scale back (1.005 -> 1.0), and
    published numbers follow that. The sign survives, so -0.004 gives -0.0.
    """
    factor = float(10**digits)
    scaled = value.cast("double") * F.lit(factor)
    size = F.abs(scaled)
    whole = F.floor(size).cast("double")
    rounded = F.signum(scaled) * (whole + F.when(size - whole >= 0.5, 1.0).otherwise(0.0))
    return F.when(size < _NO_FRACTION, rounded / F.lit(factor)).otherwise(value.cast("double"))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient that is NULL, not an error, where the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0))


def to_hour(ts: Column) -> Column:
    """Start of the hour of a zone-less timestamp, as a zone-less timestamp.

    ``date_trunc`` would go through the session time zone and return a zoned value.
    """
    return F.to_date(ts).cast("timestamp_ntz") + F.expr("INTERVAL '1' HOUR") * F.hour(ts)


def epoch_hours(value: Column, dtype: T.DataType) -> Column:
    """Hours since 1970-01-01 of a date, zoned or zone-less timestamp; never decreasing in it."""
    if isinstance(dtype, T.TimestampType):
        return F.floor(F.unix_seconds(value) / 3600)
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_date(F.to_date(value)).cast("long") * 24 + F.hour(value)
    if isinstance(dtype, T.DateType):
        return F.unix_date(value).cast("long") * 24
    raise TypeError(f"not a time column: {dtype.simpleString()}")


def cents(value: Column) -> Column:
    """A two-decimal double as a whole number, so that sums do not depend on their order."""
    return F.round(value * 100).cast("long")


def path_segment(path: Column, root: str, position: int) -> Column:
    """The n-th (from 1) folder of ``path`` below ``root``, without a ``key=`` prefix."""
    below = F.replace(path, F.lit(root.rstrip("/") + "/"), F.lit(""))
    return F.regexp_replace(F.split_part(below, F.lit("/"), F.lit(position)), "^[^=/]*=", "")


def run_id_of(path: Column) -> Column:
    """The run id in a run-scoped path, NULL where there is none."""
    return F.nullif(F.regexp_extract(path, "run=([^/]+)", 1), F.lit(""))
