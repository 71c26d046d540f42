"""Files below a folder, seen as a table. Contents are not opened."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions import path_segment, run_id_of


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _filesystem(spark, path)
    return fs.exists(hadoop_path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark reports it, with its scheme."""
    fs, hadoop_path = _filesystem(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def children(spark: SparkSession, path: str) -> set[str]:
    """Names right below a folder, from one listing; none if there is no such folder."""
    fs, hadoop_path = _filesystem(spark, path)
    return {f.getPath().getName() for f in fs.listStatus(hadoop_path)} if fs.exists(hadoop_path) else set()


def folder_bytes(spark: SparkSession, path: str) -> int | None:
    """Bytes of the Parquet files right in a folder, from one listing of it; None if there is no such folder."""
    fs, hadoop_path = _filesystem(spark, path)
    if not fs.exists(hadoop_path):
        return None
    return sum(f.getLen() for f in fs.listStatus(hadoop_path) if f.getPath().getName().endswith(".parquet"))


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a scratch folder of the caller's own."""
    fs, hadoop_path = _filesystem(spark, path)
    fs.delete(hadoop_path, True)


def list_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``path`` and ``length`` of the data files below; the content column is pruned."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .load(list(paths)).select("path", "length")
    )


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files and distinct runs by layer and dataset, from the paths alone."""
    base = qualified(spark, root)
    return (
        list_files(spark, root)
        .groupBy(
            path_segment(F.col("path"), base, 1).alias("layer"),
            path_segment(F.col("path"), base, 2).alias("dataset"),
        )
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.count_distinct(run_id_of(F.col("path"))).alias("runs"),
        )
        .orderBy("layer", "dataset")
    )


#: From this size on an input counts as large.
LARGE_MB = 16


def size_class(footprints: DataFrame, threshold_mb: float = LARGE_MB, by: tuple[str, ...] = ()) -> DataFrame:
    """``roomy`` if the inputs together, or those of a group, reach the threshold, else ``lean``; no input is lean."""
    return footprints.groupBy(*by).agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
    ).withColumn(
        "class", F.when(F.col("bytes") / 1e6 >= threshold_mb, "roomy").otherwise("lean")
    )
