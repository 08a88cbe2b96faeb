"""The whole job: load, clean, enrich, export."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from wattline.operators import add_hour_metrics, clean_readings, hourly_rollup
from wattline.schema import ENRICHED_SCHEMA, RAW_SCHEMA, READ_ORDER
from wattline.session import materialize, sized_for, work_folder
from wattline.sources import export_readings, load_readings
from wattline.sources.files import matches, remove, total_bytes

__all__ = ["JobReport", "enriched_readings", "materialize", "run"]


@dataclass(frozen=True)
class JobReport:
    """Row and column counts of the load, of what was dropped, and of the export."""

    loaded_rows: int
    loaded_columns: int
    quarantined_rows: int
    without_timestamp_rows: int
    exported_rows: int
    exported_columns: int


def enriched_readings(
    raw: DataFrame,
    order_by: Sequence[str] = (READ_ORDER,),
    formats: Iterable[str] = (),
    work: str | None = None,
    metrics: Observation | None = None,
) -> DataFrame:
    """Clean and enrich with one shuffle of the rows.

    The cleaned table is used twice, for the rollup and for the rows, and so is the rollup.
    Both are written once instead of computing the de-duplication for every use.
    """
    cleaned = materialize(clean_readings(raw, order_by, formats, metrics), "cleaned", work)
    rollup = materialize(hourly_rollup(cleaned), "rollup", work)
    return add_hour_metrics(cleaned, rollup)


def run(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    *,
    sep: str = ";",
    target_sep: str = ",",
    format: str = "csv",
    formats: Iterable[str] = (),
    strict: bool = False,
    missing: str = "error",
    ordered: bool = True,
    single_file: bool = False,
    mode: str = "overwrite",
    work: str | None = None,
) -> JobReport:
    """Read raw readings, write enriched readings, report the counts of both ends.

    Split and shuffle sizes follow the bytes of the source, unless the session was built with
    its own. Intermediate tables go to a new folder below ``work``, or below the shared folder,
    and go when the result is published. With ``missing="empty"`` an absent source gives a report
    of zeros and leaves the target as it is.
    """
    if missing == "empty" and not matches(spark, source):
        return JobReport(0, len(RAW_SCHEMA), 0, 0, 0, len(ENRICHED_SCHEMA))
    tables = f"{work}/{uuid.uuid4().hex}" if work else work_folder(spark, "run")
    loaded, cleaned, exported = Observation("loaded"), Observation("cleaned"), Observation("exported")
    with sized_for(spark, total_bytes(spark, source)):
        raw = load_readings(spark, source, sep, missing=missing, strict=strict, metrics=loaded)
        enriched = enriched_readings(raw, formats=formats, work=tables, metrics=cleaned)
        written = export_readings(
            enriched,
            target,
            target_sep,
            format=format,
            ordered=ordered,
            single_file=single_file,
            mode=mode,
            metrics=exported,
        )
    remove(spark, tables)
    # Both observations saw every row while the cleaned table was written.
    return JobReport(
        loaded_rows=loaded.get["row_count"],
        loaded_columns=len([c for c in raw.columns if c != READ_ORDER]),
        quarantined_rows=loaded.get["quarantined_count"],
        without_timestamp_rows=cleaned.get["without_timestamp_count"],
        exported_rows=exported.get["row_count"] if written else 0,
        exported_columns=len(enriched.columns),
    )
