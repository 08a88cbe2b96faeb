"""Column functions: lenient parsing and calendar parts."""

from wattline.functions.calendar import calendar_day, hour_of_day
from wattline.functions.parsing import (
    is_rejected,
    missing_to_null,
    number_or_null,
    reading,
    text_types,
    wall_clock,
)

__all__ = [
    "calendar_day",
    "hour_of_day",
    "is_rejected",
    "missing_to_null",
    "number_or_null",
    "reading",
    "text_types",
    "wall_clock",
]
