"""Operators: plain functions from DataFrame to DataFrame."""

from wattline.operators.cleaning import (
    clean_readings,
    coerce_numbers,
    drop_missing_timestamps,
    drop_redundant_date,
    drop_sentinel_rows,
    flag_consumption,
    keep_first_per_timestamp,
    parse_timestamps,
    rejected_values,
    require_columns,
    timestamp_first,
)
from wattline.operators.explore import (
    column_profile,
    first_rows,
    inferred_profile,
    last_rows,
    non_missing,
    table_shape,
)
from wattline.operators.metrics import (
    add_hour_metrics,
    add_hour_totals,
    add_peak_flags,
    daily_maxima,
    daily_peak_hours,
    hour_of_day_totals,
    hourly_rollup,
    maxima_by_day,
    totals_by_hour,
)

__all__ = [
    "add_hour_metrics",
    "add_hour_totals",
    "add_peak_flags",
    "clean_readings",
    "coerce_numbers",
    "column_profile",
    "daily_maxima",
    "daily_peak_hours",
    "drop_missing_timestamps",
    "drop_redundant_date",
    "drop_sentinel_rows",
    "first_rows",
    "flag_consumption",
    "hour_of_day_totals",
    "hourly_rollup",
    "inferred_profile",
    "keep_first_per_timestamp",
    "last_rows",
    "maxima_by_day",
    "non_missing",
    "parse_timestamps",
    "rejected_values",
    "require_columns",
    "table_shape",
    "timestamp_first",
    "totals_by_hour",
]
