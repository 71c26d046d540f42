"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.session import scratch_path

#: Bytes of one Arrow batch, and rows that a Parquet reader decodes at a time.
BATCH_BYTES, READER_ROWS = 4 << 20, 512
#: Characters that a worker turns into word objects at a time.
BLOCK_CHARS = 1 << 20
#: White space of ASCII.
_SPACE = frozenset(" \t\n\r\x0b\x0c")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``; from now on the session's Arrow batches hold at most BATCH_BYTES, and readers READER_ROWS rows.

    A worker holds a batch several times over, as Arrow data, as Python texts and as arrays, and a reader
    holds its rows in buffers that double.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    df.sparkSession.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READER_ROWS))
    return df


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of this run below the shared folder."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


class Scratch:
    """Tables computed once, as compressed files in the shared folder; removed when they are no longer read."""

    def __init__(self, spark) -> None:
        self.spark, self.paths = spark, []

    def __call__(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "rows")
        self.paths.append(path)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        for path in self.paths:
            remove(self.spark, path)
        self.paths.clear()


def with_places(docs: DataFrame, filed: Scratch) -> tuple[DataFrame, list[str]]:
    """``docs`` with a place for each row, the same in every read: that in its file, or in a copy of the rows.

    The place is in two columns, whose names are returned.
    """
    file, at = "file of the row", "place of the row"
    while {file, at} & set(docs.columns):
        file, at = file + "_", at + "_"
    try:
        return docs.select("*", F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(at)), [file, at]
    except AnalysisException:  # not read from files whose rows have numbers
        return filed(docs.select("*", F.lit(0).cast("long").alias(file), F.monotonically_increasing_id().alias(at))), [file, at]


def without_places(placed: DataFrame, goes: DataFrame, place: list[str], filed: Scratch) -> DataFrame:
    """The rows whose places are not in ``goes``.

    The list is written first, so that its size is known: a short one is broadcast, and no row is shuffled.
    """
    return placed.join(filed(goes), place, "left_anti")


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % folds


def blocks_at_space(text: str, size: int = BLOCK_CHARS) -> Iterator[str]:
    """Pieces of ``text`` of about ``size`` characters; cut at ASCII white space only, so no word is split."""
    start, end = 0, len(text)
    while end - start > size:
        cut = start + size
        while cut < end and text[cut] not in _SPACE:
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:]


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """A list column with one array per row."""
    offsets = np.zeros(len(arrays) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
