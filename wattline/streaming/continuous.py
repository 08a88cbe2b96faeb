"""Continuous aggregates over a stream of raw readings, with bounded state.

A watermark needs the zoned timestamp type, so these operators run with the session zone set
to UTC, where wall clock and instant coincide, and give zone-free values back.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions import hour_of_day
from wattline.operators.cleaning import (
    coerce_numbers,
    drop_missing_timestamps,
    drop_redundant_date,
    drop_sentinel_rows,
    flag_consumption,
    parse_timestamps,
    require_columns,
)
from wattline.operators.metrics import DAILY_MAXIMA
from wattline.schema import GRID_MEASURES, HOUR, READ_ORDER, TIMESTAMP, TOTALS


def typed_rows(stream: DataFrame, formats: Iterable[str] = ()) -> DataFrame:
    """All cleaning steps that look at one row only, so they run on a stream as they are."""
    return (
        stream.transform(require_columns)
        .transform(drop_sentinel_rows)
        .transform(coerce_numbers)
        .transform(drop_redundant_date)
        .transform(parse_timestamps, formats)
        .transform(drop_missing_timestamps)
        .transform(flag_consumption)
    )


def running_hour_totals(typed: DataFrame) -> DataFrame:
    """Totals per hour of day so far, over all rows. For complete mode; 24 keys of state."""
    return typed.groupBy(hour_of_day(F.col(TIMESTAMP)).alias(HOUR)).agg(
        *[F.sum(c).alias(TOTALS[c]) for c in GRID_MEASURES]
    )


def first_within_watermark(
    typed: DataFrame, delay: str, order_by: Sequence[str]
) -> DataFrame:
    """One row per timestamp, the first by ``order_by``, with state only up to the watermark.

    A grouped minimum in place of ``dropDuplicatesWithinWatermark``: it fixes which row
    survives, and every task reduces its duplicates before the shuffle, so a timestamp with
    very many copies does not fill one task. A row is given out when the watermark passes it;
    rows later than ``delay`` are dropped. The result's timestamp is zoned (UTC).
    """
    zone = typed.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT"):
        raise ValueError(f"streams need spark.sql.session.timeZone=UTC, not {zone}")
    values = [c for c in typed.columns if c not in (TIMESTAMP, READ_ORDER)]
    return (
        typed.withColumn(TIMESTAMP, F.col(TIMESTAMP).cast("timestamp"))
        .withWatermark(TIMESTAMP, delay)
        .groupBy(TIMESTAMP)
        .agg(F.min_by(F.struct(*values), F.struct(*order_by)).alias("row"))
        .select(TIMESTAMP, "row.*")
    )


def closed_daily_maxima(unique: DataFrame) -> DataFrame:
    """The maxima of each day the watermark has closed, from a watermarked stream.

    For append mode. Chains onto ``first_within_watermark``.
    """
    return (
        unique.groupBy(F.window(TIMESTAMP, "1 day"))
        .agg(*[F.max(c).alias(DAILY_MAXIMA[c]) for c in GRID_MEASURES])
        .select(F.to_date("window.start").alias("day"), *DAILY_MAXIMA.values())
    )
