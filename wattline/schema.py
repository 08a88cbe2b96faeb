"""The readings contract: column names, types and the fixed values of the data format."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

TIMESTAMP = "timestamp"
PURCHASE = "grid_purchase"
FEEDIN = "grid_feedin"
CONSUMPTION = "direct_consumption"

GRID_MEASURES = (PURCHASE, FEEDIN)
NUMERIC_COLUMNS = (PURCHASE, FEEDIN, CONSUMPTION)
REQUIRED_COLUMNS = (TIMESTAMP, PURCHASE, FEEDIN, CONSUMPTION)

CONSUMPTION_FLAG = "direct_consumption_flag"
TOTALS = {PURCHASE: "grid_purchase_total", FEEDIN: "grid_feedin_total"}
PEAK_FLAGS = {PURCHASE: "max_grid_purchase_hour", FEEDIN: "max_grid_feedin_hour"}

HOUR = "hour"
DAY = "reading_day"
READ_ORDER = "_read_order"

# Fixed values of the data format.
REDUNDANT_DATE = "date"
SENTINEL = "Dev test"
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)

# A nanosecond clock in 64 bits reaches this far; timestamps outside it count as missing.
# The range also bounds the number of calendar days in any cleaned table.
EARLIEST = "1677-09-21 00:12:43.145225"
LATEST = "2262-04-11 23:47:16.854775"
MAX_DAYS = (dt.datetime.fromisoformat(LATEST) - dt.datetime.fromisoformat(EARLIEST)).days + 2

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in REQUIRED_COLUMNS])

CLEAN_SCHEMA = T.StructType(
    [T.StructField(TIMESTAMP, T.TimestampNTZType())]
    + [T.StructField(c, T.LongType()) for c in NUMERIC_COLUMNS]
    + [T.StructField(CONSUMPTION_FLAG, T.BooleanType())]
)

ENRICHED_SCHEMA = T.StructType(
    CLEAN_SCHEMA.fields
    + [T.StructField(c, T.LongType()) for c in TOTALS.values()]
    + [T.StructField(c, T.BooleanType()) for c in PEAK_FLAGS.values()]
)


class ContractError(ValueError):
    """The input does not have the columns an operator needs."""


def quoted(name: str) -> str:
    """Column reference that is safe for names with dots, spaces or backticks."""
    return "`" + name.replace("`", "``") + "`"
