"""A first look at a raw table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions import text_types
from wattline.schema import READ_ORDER, quoted


def column_profile(df: DataFrame) -> DataFrame:
    """Row count, non-null count and type per column, from one pass over the data."""
    fields = [f for f in df.schema.fields if f.name != READ_ORDER]
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(quoted(f.name)).alias(f"n{i}") for i, f in enumerate(fields)],
    )
    lines = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("rows").alias("row_count"),
            F.col(f"n{i}").alias("non_null_count"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*lines)))


def inferred_profile(df: DataFrame) -> DataFrame:
    """``column_profile`` with the narrowest type that all present values of a text column have.

    Types are whole numbers below decimal numbers, days below timestamps, and truth values; what
    fits none of them, or is of two kinds, is text, and a column without values is ``void``. Per
    column and type one count is kept, so partial results add up. Columns that are not text keep
    their type.
    """
    fields = [f for f in df.schema.fields if f.name != READ_ORDER]
    counts = [F.count(F.lit(1)).alias("rows")]
    for i, field in enumerate(fields):
        value = F.col(quoted(field.name))
        counts.append(F.count(value).alias(f"n{i}"))
        if isinstance(field.dataType, T.StringType):
            counts += [F.count_if(fits).alias(f"n{i}_{name}") for name, fits in text_types(value).items()]
    lines = []
    for i, field in enumerate(fields):
        kind = F.lit(field.dataType.simpleString())
        if isinstance(field.dataType, T.StringType):
            kind = F.when(F.col(f"n{i}") == 0, "void")
            for name in text_types(F.lit("")):
                kind = kind.when(F.col(f"n{i}_{name}") == F.col(f"n{i}"), name)
            kind = kind.otherwise("string")
        lines.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                kind.alias("data_type"),
                F.col("rows").alias("row_count"),
                F.col(f"n{i}").alias("non_null_count"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*lines)))


def table_shape(df: DataFrame) -> DataFrame:
    """Row and column count of a table, as one row."""
    width = len([c for c in df.columns if c != READ_ORDER])
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(width).cast("bigint")
    )


def non_missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(quoted(column)).isNotNull())


def first_rows(df: DataFrame, n: int = 10, order_by: Sequence[str] = (READ_ORDER,)) -> DataFrame:
    """The first rows in source order; a top-n per task, never a full sort."""
    return df.orderBy(*order_by).limit(n)


def last_rows(df: DataFrame, n: int = 10, order_by: Sequence[str] = (READ_ORDER,)) -> DataFrame:
    """The last rows, shown in source order."""
    backwards = df.orderBy(*[F.desc(c) for c in order_by]).limit(n)
    return backwards.orderBy(*order_by)
