"""What the footers of Parquet files say, read by tasks over the list of files; no data page is opened."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattlake.session import small_table
from wattlake.sources.files import exists, list_files, qualified

_SCHEMA = (
    "path string, length bigint, rows bigint, row_groups bigint, "
    "columns array<struct<name:string,kind:string,compressed:bigint,nulls:bigint,least:string,most:string>>, error string"
)
#: Python types of statistics that are exact.
_EXACT = (int, bool, date, datetime, Decimal)
_COLUMN = ("name", "kind", "compressed", "nulls", "least", "most")
#: Physical types that a column of a catalog type may be stored as.
_STORED = {
    "string": {"BYTE_ARRAY"}, "double": {"DOUBLE", "FLOAT"}, "bigint": {"INT64", "INT32"}, "int": {"INT32"}, "boolean": {"BOOLEAN"},
    "date": {"INT32"}, "timestamp_ntz": {"INT64", "INT96"}, "timestamp": {"INT64", "INT96"},
}


def footers(spark: SparkSession, *paths: str) -> DataFrame:
    """A row for each file below the paths: rows, row groups, and for each column its stored type, bytes, nulls and range.

    ``error`` says why a footer can't be read; such a file has no rows. Nulls are NULL where a row group does not
    tell them. ``least`` and ``most`` are the smallest and greatest value as text; they are NULL if a row group with
    values does not tell them, and for texts and floating-point numbers, whose statistics may be cut or leave NaN out. The list of files is dealt over the tasks, each of which reads a few kilobytes a file. Files are
    opened through ``pyarrow.fs``, so the store must be one that it knows.
    """
    def look(batches):
        for files in batches:
            found = [_footer(path) for path in files.column(0).to_pylist()]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([(n, pa.int64() if n in ("compressed", "nulls") else pa.string()) for n in _COLUMN])), pa.string()]
            arrays = [pa.array([x[i] for x in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*files.columns, *arrays], ["path", "length", "rows", "row_groups", "columns", "error"])

    files = list_files(spark, *paths).filter(~F.element_at(F.split("path", "/"), -1).startswith("_"))
    return files.repartition(spark.sparkContext.defaultParallelism).mapInArrow(look, _SCHEMA)


def _footer(path: str) -> tuple:
    try:
        store, inner = pyarrow.fs.FileSystem.from_uri(path)
        with store.open_input_file(inner) as stream:
            meta = pq.ParquetFile(stream).metadata
    except (OSError, pa.ArrowException) as error:
        return 0, 0, None, f"{type(error).__name__}: {str(error)[:200]}"
    columns: dict[str, list] = {}
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        for c in range(group.num_columns):
            part = group.column(c)
            own = columns.setdefault(part.path_in_schema, [part.physical_type, 0, 0, []])
            known = part.is_stats_set and part.statistics.has_null_count
            own[1] += part.total_compressed_size
            own[2] = own[2] + part.statistics.null_count if known and own[2] is not None else None
            if known and part.statistics.null_count == group.num_rows:
                continue  # no values, no range
            ends = part.is_stats_set and part.statistics.has_min_max and [part.statistics.min, part.statistics.max]
            own[3] = own[3] + ends if own[3] is not None and ends and isinstance(ends[0], _EXACT) else None
    return meta.num_rows, meta.num_row_groups, [
        dict(zip(_COLUMN, (name, kind, size, nulls, str(min(ends)) if ends else None, str(max(ends)) if ends else None)))
        for name, (kind, size, nulls, ends) in columns.items()
    ], None


def column_bytes(found: DataFrame) -> DataFrame:
    """``name, compressed, nulls`` over all files of ``footers``."""
    return found.select(F.explode("columns").alias("c")).groupBy("c.name").agg(
        F.sum("c.compressed").alias("compressed"),
        F.when(F.count(F.lit(1)) == F.count("c.nulls"), F.sum("c.nulls")).alias("nulls"),
    )


def unfit_files(spark: SparkSession, paths: Sequence[str], schema: str) -> DataFrame:
    """``path, reason`` of the files whose footer can't be read or stores a column of ``schema`` as another type."""
    expected = [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(schema).fields]
    kinds = F.create_map(*(x for name, kind in expected for x in (F.lit(name), F.array(*map(F.lit, sorted(_STORED.get(kind, ())))))))
    wrong = F.filter("columns", lambda c: F.map_contains_key(kinds, c["name"]) & ~F.array_contains(F.element_at(kinds, c["name"]), c["kind"]))
    names = F.transform(wrong, lambda c: F.concat(c["name"], F.lit(" is stored as "), c["kind"]))
    reason = F.coalesce("error", F.when(F.size(names) > 0, F.array_join(names, ", ")))
    return footers(spark, *paths).select("path", reason.alias("reason")).filter("reason IS NOT NULL")


def _below(spark: SparkSession, found: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Files beside each given path (``base``) that they are below, by equality of the first parts of their paths."""
    bases = [{"base": p, "start": qualified(spark, p).rstrip("/")} for p in dict.fromkeys(paths)]
    depths = sorted({b["start"].count("/") + 1 for b in bases})
    parts = F.split("path", "/")
    starts = F.array(*(F.concat_ws("/", F.slice(parts, 1, d)) for d in depths))
    named = small_table(spark, bases, "base string, start string")
    return found.withColumn("start", F.explode(F.array_distinct(starts))).join(F.broadcast(named), "start")


def footprint(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Files, bytes and rows of each Parquet path, from one pass over the footers below all of them.

    Zeros for a path that has no files or isn't there. A file whose footer can't be read has bytes but no rows. The
    broadcast side has a row per given path.
    """
    there = [path for path in paths if exists(spark, path)]
    named = small_table(spark, [{"path": p} for p in dict.fromkeys(paths)], "path string")
    zero = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    if not there:
        return named.select("path", *(F.lit(0).cast("bigint").alias(n) for n in ("files", "rows", "bytes")))
    sizes = _below(spark, footers(spark, *there), there).groupBy(F.col("base").alias("path")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("length").alias("bytes")
    )
    return named.join(sizes, "path", "left").select("path", zero("files"), zero("rows"), zero("bytes"))


def column_ranges(found: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One row: ``rows``, and for each column a struct ``nulls, least, most`` in its type, NULL where footers don't tell.

    The footers tell a range if every file that has a value tells it. A column that a file lacks is NULL in all its rows.
    """
    def of(name: str, kind: str):
        own = F.try_element_at(F.filter("columns", lambda c: c["name"] == name), F.lit(1))
        missing = own.isNull()
        nulls = F.when(missing, F.col("rows")).otherwise(own["nulls"])
        told = missing | F.coalesce(own["nulls"] == F.col("rows"), F.lit(False)) | own["least"].isNotNull()
        whole = lambda value: F.when(F.bool_and(told), value)
        return F.struct(
            F.when(F.count(F.lit(1)) == F.count(nulls), F.sum(nulls)).alias("nulls"),
            whole(F.min(own["least"].cast(kind))).alias("least"), whole(F.max(own["most"].cast(kind))).alias("most"),
            F.coalesce(F.bool_and(told), F.lit(True)).alias("told"),
        ).alias(name)

    return found.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("_rows"), F.count("error").alias("_unread"), *(of(n, k) for n, k in types.items()))
