"""Checks of files from their footers, where those tell enough; the rest from the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from wattlake.quality import RULES, Check, Expectation, evaluate
from wattlake.sources.footers import column_ranges, footers
from pyspark.sql.types import StructType

_TOLD = ("row_count_min", "row_count_max", "not_null", "between")


def evaluate_files(
    spark: SparkSession, expectations: Sequence[Expectation], paths: Mapping[str, str], schemas: Mapping[str, str]
) -> list[Check]:
    """The report that ``quality.evaluate`` gives for the datasets at ``paths``, with as few data pages read as possible.

    Row counts and nulls are sums over footers, and a range is kept if the least and the greatest value are inside.
    Where a footer can't be read or doesn't tell, or values are out of range and have to be counted, the check is
    evaluated on the rows. One job per dataset reads footers; only a row of numbers of each reaches the driver.
    """
    ranges = {}
    for dataset in dict.fromkeys(e.dataset for e in expectations if e.kind in _TOLD and e.dataset in paths):
        kinds = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(schemas[dataset]).fields}
        wanted = {e.column: kinds[e.column] for e in expectations if e.dataset == dataset and e.column in kinds}
        ranges[dataset] = column_ranges(footers(spark, paths[dataset]), wanted).first()
    checks: dict[int, Check] = {}
    for i, e in enumerate(expectations):
        number = _number(e, ranges.get(e.dataset))
        if number is not None:
            passed, observed, expected = RULES[e.kind](e).judge(number)
            checks[i] = Check(e.name, e.kind, e.dataset, e.column, e.severity, passed, observed, expected)
    rest = [i for i in range(len(expectations)) if i not in checks]
    if rest:
        frames = {name: spark.read.schema(schemas[name]).parquet(path) for name, path in paths.items()}
        checks |= dict(zip(rest, evaluate([expectations[i] for i in rest], frames)))
    return [checks[i] for i in range(len(expectations))]


def _number(e: Expectation, told) -> int | None:
    """The number that the rule judges, if footers tell it."""
    if told is None or told["_unread"] or e.kind not in _TOLD:
        return None
    if e.kind.startswith("row_count"):
        return told["_rows"]
    if e.column not in told.__fields__:
        return None
    own = told[e.column]
    if e.kind == "not_null":
        return own["nulls"]
    if not own["told"]:
        return None
    try:
        inside = own["least"] is None or e.params["min"] <= own["least"] and own["most"] <= e.params["max"]
    except TypeError:  # limits of another type are for Spark to compare
        return None
    return 0 if inside else None
