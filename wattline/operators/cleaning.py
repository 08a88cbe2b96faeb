"""Cleaning: from raw text rows to typed readings with one row per timestamp."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from wattline.functions import is_rejected, reading, wall_clock
from wattline.schema import (
    CONSUMPTION,
    CONSUMPTION_FLAG,
    NUMERIC_COLUMNS,
    READ_ORDER,
    REDUNDANT_DATE,
    REQUIRED_COLUMNS,
    SENTINEL,
    TIMESTAMP,
    ContractError,
    quoted,
)


def require_columns(df: DataFrame, names: Iterable[str] = REQUIRED_COLUMNS) -> DataFrame:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ContractError(f"missing required columns: {', '.join(absent)}")
    return df


def drop_sentinel_rows(df: DataFrame) -> DataFrame:
    """Remove the test rows. Null-safe: a missing consumption is not a test row."""
    return df.where(~F.col(CONSUMPTION).cast("string").eqNullSafe(SENTINEL))


def coerce_numbers(df: DataFrame) -> DataFrame:
    """The three readings as BIGINT, never null."""
    return df.withColumns({c: reading(F.col(c)) for c in NUMERIC_COLUMNS})


def rejected_values(df: DataFrame) -> DataFrame:
    """Per numeric column, how many present values count as 0 because they do not parse."""
    counts = df.agg(*[F.count_if(is_rejected(F.col(c))).alias(c) for c in NUMERIC_COLUMNS])
    return counts.unpivot([], list(NUMERIC_COLUMNS), "column_name", "rejected_count")


def drop_redundant_date(df: DataFrame) -> DataFrame:
    return df.drop(REDUNDANT_DATE)


def parse_timestamps(df: DataFrame, formats: Iterable[str] = ()) -> DataFrame:
    return df.withColumn(TIMESTAMP, wall_clock(F.col(TIMESTAMP), formats))


def drop_missing_timestamps(df: DataFrame) -> DataFrame:
    return df.dropna(subset=[TIMESTAMP])


def keep_first_per_timestamp(
    df: DataFrame, order_by: Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """One row per timestamp (and value of ``within``): the first by ``order_by``, a total order.

    The rank filter lets every task keep its own first row per timestamp before the shuffle,
    so a timestamp that holds a large share of all rows arrives as one row per task. The
    shuffle is by timestamp, not by day: a day that is large stays spread over the cluster.
    """
    rank = F.row_number().over(Window.partitionBy(TIMESTAMP, *within).orderBy(*order_by))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def flag_consumption(df: DataFrame) -> DataFrame:
    return df.withColumn(CONSUMPTION_FLAG, F.col(CONSUMPTION) > 0)


def timestamp_first(df: DataFrame) -> DataFrame:
    """The key column leads; the others stay in source order."""
    return df.select(TIMESTAMP, *[quoted(c) for c in df.columns if c != TIMESTAMP])


def clean_readings(
    df: DataFrame,
    order_by: Sequence[str] = (READ_ORDER,),
    formats: Iterable[str] = (),
    metrics: Observation | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Raw readings to cleaned readings; unknown columns pass through.

    ``order_by`` says which of several rows with one timestamp comes first. Tables loaded
    with ``load_readings`` carry it; for others name columns with a natural sequence, which
    are kept. ``within`` names what a first row is looked for in besides its timestamp, as the file
    it came from. The order of steps matters: test rows go first, so they neither turn into
    zeros nor shadow a real row with their timestamp. ``metrics`` receives
    ``without_timestamp_count``, the rows dropped because their timestamp is missing, unreadable
    or out of range; as with every observation only an action over all rows counts them all.
    """
    typed = (
        df.transform(require_columns)
        .transform(require_columns, order_by)
        .transform(drop_sentinel_rows)
        .transform(coerce_numbers)
        .transform(drop_redundant_date)
        .transform(parse_timestamps, formats)
    )
    if metrics is not None:
        dropped = F.count_if(F.col(TIMESTAMP).isNull()).alias("without_timestamp_count")
        typed = typed.observe(metrics, dropped)
    return (
        typed.transform(drop_missing_timestamps)
        .transform(keep_first_per_timestamp, order_by, within)
        .transform(flag_consumption)
        .transform(timestamp_first)
        .drop(READ_ORDER)
    )
