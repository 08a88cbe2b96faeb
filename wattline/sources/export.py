"""Results out: delimited text or Parquet, and the way back in."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.schema import ENRICHED_SCHEMA, READ_ORDER, TIMESTAMP, quoted
from wattline.sources.delimited import text_options
from wattline.sources.files import (
    add_files,
    add_snapshot,
    beside,
    current_snapshot,
    drop_snapshots,
    exists,
    names_in,
    publish,
    remove,
)


def export_readings(
    df: DataFrame,
    path: str,
    sep: str = ",",
    *,
    format: str = "csv",
    ordered: bool = True,
    single_file: bool = False,
    mode: str = "overwrite",
    snapshots: int = 0,
    metrics: Observation | None = None,
) -> bool:
    """Write a table to a folder; returns False and changes nothing if it has no rows.

    Rows are written to a folder beside the target, which takes the target's place when all of
    them are there: a failing export leaves the last good result. ``mode`` is ``overwrite``,
    ``append`` (adds the new part files), ``ignore`` or ``errorifexists``. ``ordered``
    range-partitions and sorts by timestamp, so part files follow each other in time.
    With ``snapshots`` every export is a new folder below ``path``, which is never moved; an empty
    file written last makes it the one that ``read_export`` reads, and the last so many stay for
    readers at work. So there is no moment without a result, also on an object store.
    ``single_file`` is for small results: one task writes everything. ``metrics`` receives
    ``row_count`` of the write, over all rows. The internal order column is left out.
    """
    if format not in ("csv", "parquet"):
        raise ValueError("format must be 'csv' or 'parquet'")
    spark = df.sparkSession
    there = exists(spark, path)
    if there and mode == "ignore":
        return False
    if there and mode not in ("overwrite", "append"):
        raise FileExistsError(path)
    if snapshots and mode == "append":
        raise ValueError("a snapshot is a whole result")
    if snapshots and there and names_in(spark, path) and current_snapshot(spark, path) is None:
        raise FileExistsError(f"{path} holds a result without snapshots")
    df = df.drop(READ_ORDER)
    if ordered:
        df = df.orderBy(TIMESTAMP)
    if single_file:
        df = df.coalesce(1)
    counted = metrics if metrics is not None else Observation()
    df = df.observe(counted, F.count(F.lit(1)).alias("row_count"))
    name = f"snapshot-{uuid.uuid4().hex}"
    staged = f"{path}/{name}" if snapshots else beside(path, "staged")
    try:
        if format == "parquet":
            df.write.parquet(staged)
        else:
            options = text_options(sep) | {
                "ignoreLeadingWhiteSpace": False,
                "ignoreTrailingWhiteSpace": False,
            }
            as_text(df).write.options(**options).csv(staged)
        if not counted.get["row_count"]:
            remove(spark, staged)
            return False
        if snapshots:
            add_snapshot(spark, path, name)
        elif there and mode == "append":
            add_files(spark, staged, path)
        else:
            publish(spark, staged, path)
    except BaseException:
        remove(spark, staged)
        raise
    if snapshots:
        drop_snapshots(spark, path, snapshots)
    return True


def as_text(df: DataFrame) -> DataFrame:
    """Booleans as True/False; timestamps to the second, with a fraction only where one exists."""

    def shown(field: T.StructField):
        column = F.col(quoted(field.name))
        if isinstance(field.dataType, T.BooleanType):
            column = F.when(column, "True").when(~column, "False")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            column = column.cast("string")
        return column.alias(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def read_export(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    *,
    schema: T.StructType = ENRICHED_SCHEMA,
) -> DataFrame:
    """Read an exported folder, or its current snapshot, back with its types."""
    path = current_snapshot(spark, path) or path
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = spark.read.schema(text).options(**text_options(sep)).option("enforceSchema", False).csv(path)
    return rows.select(
        *[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
