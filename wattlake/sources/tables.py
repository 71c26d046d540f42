"""Partitioned tables of the session's catalog, whose dates are replaced by name."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattlake.session import scratch_path
from wattlake.sources.files import remove


def ensure_table(spark: SparkSession, name: str, schema: str, by: str, location: str) -> None:
    """A Parquet table at ``location``, partitioned by the date column ``by`` of ``schema``, unless it exists."""
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromDDL(schema).fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{by}`) LOCATION '{location}'")


def replace_date(rows: DataFrame, name: str, by: str, day: date) -> None:
    """Makes ``rows`` the whole content of one date; no rows clear it. Other dates stay as they are.

    Columns are matched by name and cast to the table's types; one that is missing is NULL, an unknown one is an error,
    as are rows of another date. A static overwrite clears the date before its job runs, so the rows are first written to the
    shared scratch folder: what fails until then, a row of another date included, leaves the date as it was, and the rows may come from
    the table itself.
    """
    spark = rows.sparkSession
    kept = spark.table(name).schema
    unknown = sorted(set(rows.columns) - set(kept.names))
    if unknown:
        raise ValueError(f"{name} has no column {', '.join(unknown)}")
    columns = [
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in kept.fields if f.name != by
    ]
    own = rows
    if by in rows.columns:
        strange = F.raise_error(F.concat(F.lit(f"{name}: a row is of "), F.coalesce(F.col(by).cast("string"), F.lit("no date"))))
        own = rows.filter(F.when(F.col(by).eqNullSafe(F.lit(day)), F.lit(True)).otherwise(strange.cast("boolean")))
    staged = scratch_path(spark, "replaced_date")
    own.select(*columns).write.parquet(staged)
    view = f"_rows_{uuid.uuid4().hex}"
    spark.read.parquet(staged).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (`{by}` = DATE'{day.isoformat()}') BY NAME SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
    remove(spark, staged)
