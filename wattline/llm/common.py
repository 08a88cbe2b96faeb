"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.plans.job import materialize
from wattline.sources.files import remove

#: Words are runs of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Keys that a join asks for go ahead of it as a Bloom filter of at most 8 MB, so that rows whose
#: key is not asked for are not shuffled. What the filter lets through by mistake, the join drops.
_PREFILTER = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "10GB",
}

_CLEANED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

#: Texts take half the room that they take by default, for some more time to write.
_COMPACT = {"spark.sql.parquet.compression.codec": "zstd"}

BATCH_ROWS = 1_000

#: Stands for a null id inside pandas, which would turn a column with nulls into doubles.
NO_ID = -(2**63)

__all__ = [
    "NO_ID",
    "SPACE",
    "WORD",
    "compact_tables",
    "filled",
    "forget",
    "materialize",
    "matching",
    "prefiltered",
    "ranked",
    "read_table",
    "running_totals",
    "shuffles_cleaned",
    "small_batches",
    "unfilled",
    "word_count",
]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def matching(rows: DataFrame, wanted: DataFrame, key: str, purpose: str) -> DataFrame:
    """The inner join of ``rows`` with the few ``wanted`` keys, written as a table."""
    wanted = materialize(wanted.withColumn("_asked", F.lit(1)), f"{purpose}-keys")
    with prefiltered(rows.sparkSession):
        found = materialize(rows.join(wanted.where("_asked > 0").drop("_asked"), key), purpose)
    forget(wanted)
    return found


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings that hold for what is run inside."""
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def prefiltered(spark: SparkSession):
    """Joins run inside send keys ahead from a side that has a filter."""
    return settings(spark, _PREFILTER)


def shuffles_cleaned(spark: SparkSession):
    """What is run inside, tables written at once, leaves no shuffle files behind."""
    return settings(spark, _CLEANED)


def compact_tables(spark: SparkSession):
    """Tables written inside are small rather than written fast."""
    return settings(spark, _COMPACT)


def forget(*tables: DataFrame) -> None:
    """Deletes tables that ``materialize`` wrote and nothing reads any more."""
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            remove(table.sparkSession, folder)


def small_batches(spark: SparkSession) -> None:
    """Rows that hold whole texts go to Python workers by the thousand, not by ten thousand.

    Spark reads the setting when a plan runs, after the operator has returned, so it stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def filled(column: str) -> Column:
    return F.coalesce(F.col(column).cast("bigint"), F.lit(NO_ID)).alias(column)


def unfilled(column: str) -> Column:
    return F.when(F.col(column) != NO_ID, F.col(column)).alias(column)


def word_count(text: Column) -> Column:
    """Words of a text as BIGINT; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    values: dict[str, str],
    purpose: str,
) -> DataFrame:
    """Adds, for each pair (value column: new column), the sum of all earlier rows of the group.

    A group may hold any share of the rows: rows are dealt by ranges of (group, order), so a
    large group spans many partitions. Each partition adds up its own rows, the sums of the
    partitions before it come from one row per group and partition. The dealt rows are written
    once, since range bounds come from a sample and must not change between the two uses.
    Nulls form a group of their own and sort first. Rows equal in group and order get their
    places in an arbitrary order, so give an order that tells rows with different values apart.
    """
    keys = [F.col(c) for c in (*group, *order)]
    dealt = df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id())
    dealt = materialize(dealt, purpose)
    names = {value: f"_sum_{i}" for i, value in enumerate(values)}
    parts = dealt.groupBy(*group, "_part").agg(*(F.sum(v).alias(n) for v, n in names.items()))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *(F.col(c).alias(f"_{c}_") for c in group),
        F.col("_part").alias("_part_"),
        *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before{n}") for n in names.values()),
    )
    same = F.col("_part") == F.col("_part_")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}_"))
    inside = (
        Window.partitionBy(*group, "_part")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = dealt.withColumns(
        {f"_in{n}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v, n in names.items()}
    )
    joined = summed.join(offsets, same)
    return joined.select(
        *df.columns,
        *(
            (F.col(f"_in{names[v]}") + F.col(f"_before{names[v]}")).alias(new)
            for v, new in values.items()
        ),
    )


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[str], purpose: str) -> DataFrame:
    """Adds ``rank`` from 0 within each group, without gathering a group in one task."""
    return running_totals(df.withColumn("_one", F.lit(1)), group, order, {"_one": "rank"}, purpose).drop("_one")
