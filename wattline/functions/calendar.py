"""Calendar parts of the wall clock. On TIMESTAMP_NTZ none of them looks at the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def calendar_day(ts: Column) -> Column:
    return F.to_date(ts)
