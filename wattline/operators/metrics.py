"""Metrics over cleaned readings: totals per hour of day, daily maxima, peak flags.

All of them come from one small rollup per calendar day and hour. It is made with partial
aggregation, so no row-level shuffle is needed, and rollups of parts add up to the rollup of
the whole. The lookup tables joined back to the rows are broadcast; their size is bounded by
the calendar: 24 hours, and at most ``schema.MAX_DAYS`` (213,505) days because cleaning
accepts no timestamp outside that range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions import calendar_day, hour_of_day
from wattline.operators.cleaning import require_columns
from wattline.schema import (
    DAY,
    GRID_MEASURES,
    HOUR,
    PEAK_FLAGS,
    TIMESTAMP,
    TOTALS,
    ContractError,
    quoted,
)
from wattline.session import materialize

DAILY_MAXIMA = {c: f"max_{c}" for c in GRID_MEASURES}


def hourly_rollup(cleaned: DataFrame) -> DataFrame:
    """Sum and maximum of each grid measure per calendar day and hour."""
    ts = F.col(TIMESTAMP)
    return cleaned.groupBy(calendar_day(ts).alias(DAY), hour_of_day(ts).alias(HOUR)).agg(*rollup_measures())


def rollup_measures() -> list[Column]:
    return [
        *[F.sum(c).alias(TOTALS[c]) for c in GRID_MEASURES],
        *[F.max(c).alias(DAILY_MAXIMA[c]) for c in GRID_MEASURES],
    ]


def totals_by_hour(rollup: DataFrame) -> DataFrame:
    """Totals per hour of day over all days: at most 24 rows."""
    return rollup.groupBy(HOUR).agg(*[F.sum(c).alias(c) for c in TOTALS.values()])


def maxima_by_day(rollup: DataFrame) -> DataFrame:
    """The largest reading of each calendar day."""
    return rollup.groupBy(DAY).agg(*[F.max(c).alias(c) for c in DAILY_MAXIMA.values()])


def hour_of_day_totals(cleaned: DataFrame) -> DataFrame:
    return totals_by_hour(hourly_rollup(cleaned))


def daily_maxima(cleaned: DataFrame) -> DataFrame:
    return maxima_by_day(hourly_rollup(cleaned))


def daily_peak_hours(cleaned: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    """Per day and measure, the hour or hours with the day's largest total."""
    rollup = hourly_rollup(cleaned) if rollup is None else rollup
    totals = rollup.groupBy(DAY, HOUR).agg(*[F.sum(TOTALS[c]).alias(c) for c in GRID_MEASURES])
    long = totals.unpivot([DAY, HOUR], list(GRID_MEASURES), "measure", "total")
    # Never more than 24 rows per window.
    rank = F.rank().over(Window.partitionBy(DAY, "measure").orderBy(F.desc("total")))
    return (
        long.withColumn("_rank", rank)
        .where("_rank = 1")
        .select(F.col(DAY).alias("day"), "measure", HOUR, "total")
    )


def add_hour_totals(cleaned: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    """Join the totals of each row's hour of day."""
    rollup = hourly_rollup(cleaned) if rollup is None else rollup
    kept = [quoted(c) for c in cleaned.columns if c != HOUR]
    return (
        cleaned.withColumn(HOUR, hour_of_day(F.col(TIMESTAMP)))
        .join(F.broadcast(totals_by_hour(rollup)), HOUR, "left")
        .select(*kept, *TOTALS.values())
    )


def add_peak_flags(cleaned: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    """Flag the rows that equal their day's maximum; all ties are flagged."""
    rollup = hourly_rollup(cleaned) if rollup is None else rollup
    flags = {PEAK_FLAGS[c]: F.col(c) == F.col(DAILY_MAXIMA[c]) for c in GRID_MEASURES}
    return (
        cleaned.withColumn(DAY, calendar_day(F.col(TIMESTAMP)))
        .join(F.broadcast(maxima_by_day(rollup)), DAY, "left")
        .withColumns(flags)
        .drop(DAY, *DAILY_MAXIMA.values())
    )


def add_hour_metrics(cleaned: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    """Add the two totals and the two peak flags to every row.

    Without a ``rollup`` the cleaned rows are computed once, written to the shared work folder
    together with their rollup, and read from there: two uses of a plan would clean twice. With a
    rollup made before (a written table, a stream's running rollup) nothing is written and the
    rows should come from a table as well. A source column named ``hour`` is dropped.
    """
    require_columns(cleaned, (TIMESTAMP, *GRID_MEASURES))
    taken = {*TOTALS.values(), *PEAK_FLAGS.values(), *DAILY_MAXIMA.values(), DAY}
    clash = sorted(taken & set(cleaned.columns))
    if clash:
        raise ContractError(f"columns already exist: {', '.join(clash)}")
    if rollup is None:
        cleaned = materialize(cleaned, "cleaned")
        rollup = materialize(hourly_rollup(cleaned), "rollup")
    return cleaned.transform(add_hour_totals, rollup).transform(add_peak_flags, rollup)
