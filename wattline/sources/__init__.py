"""Sources and sinks."""

from wattline.sources.delimited import (
    header_columns,
    load_readings,
    read_order,
    read_quarantine,
    stream_readings,
)
from wattline.sources.ends import first_of_files, last_of_files
from wattline.sources.export import as_text, export_readings, read_export
from wattline.sources.tables import as_readings, events_as_readings, read_events

__all__ = [
    "as_readings",
    "as_text",
    "events_as_readings",
    "export_readings",
    "first_of_files",
    "header_columns",
    "last_of_files",
    "load_readings",
    "read_events",
    "read_export",
    "read_order",
    "read_quarantine",
    "stream_readings",
]
