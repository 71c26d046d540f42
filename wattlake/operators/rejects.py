"""Casts that set aside what cannot be cast instead of failing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REASON = "cast_errors"


def cast_or_reason(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """``df`` with the columns cast, and ``cast_errors``: an array of "column: value" for values that have no such type.

    A value that can't be cast becomes NULL; NULLs and values that can are no errors, and the array is then empty.
    One pass, no shuffle; other columns stay as they are.
    """
    failed = [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull(), F.concat(F.lit(f"{c}: "), F.col(c).cast("string")))
        for c, kind in types.items()
    ]
    cast = {c: F.col(c).try_cast(kind) for c, kind in types.items()}
    return df.withColumns({REASON: F.array_compact(F.array(*failed))} | cast)
