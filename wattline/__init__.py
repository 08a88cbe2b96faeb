"""Analytics for time-stamped electricity readings on Spark."""

from wattline.operators import (
    add_hour_metrics,
    clean_readings,
    daily_peak_hours,
    hour_of_day_totals,
)
from wattline.plans import JobReport, enriched_readings, run
from wattline.session import build_session
from wattline.sources import export_readings, load_readings, read_export, read_quarantine

__all__ = [
    "JobReport",
    "add_hour_metrics",
    "build_session",
    "clean_readings",
    "daily_peak_hours",
    "enriched_readings",
    "export_readings",
    "hour_of_day_totals",
    "load_readings",
    "read_export",
    "read_quarantine",
    "run",
]
