"""Streaming forms of the recurring refresh."""

from wattline.streaming.continuous import (
    closed_daily_maxima,
    first_within_watermark,
    running_hour_totals,
    typed_rows,
)
from wattline.streaming.refresh import follow, refresh
from wattline.streaming.tier import (
    compact,
    ingest,
    read_clean,
    read_commits,
    read_enriched,
    read_quarantined,
    read_rollup,
    write_batch,
)

__all__ = [
    "closed_daily_maxima",
    "compact",
    "first_within_watermark",
    "follow",
    "ingest",
    "read_clean",
    "read_commits",
    "read_enriched",
    "read_quarantined",
    "read_rollup",
    "refresh",
    "running_hour_totals",
    "typed_rows",
    "write_batch",
]
