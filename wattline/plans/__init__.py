"""Composed jobs."""

from wattline.plans.job import JobReport, enriched_readings, materialize, run

__all__ = ["JobReport", "enriched_readings", "materialize", "run"]
