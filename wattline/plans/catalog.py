"""Named queries over the test tables: one or more per operator.

Each takes a session and a folder of tables and returns a DataFrame. ``events`` is viewed as
raw readings with ``event_id`` as their sequence.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions import missing_to_null
from wattline.operators import (
    add_hour_metrics,
    add_hour_totals,
    add_peak_flags,
    clean_readings,
    coerce_numbers,
    column_profile,
    daily_maxima,
    daily_peak_hours,
    drop_missing_timestamps,
    drop_redundant_date,
    drop_sentinel_rows,
    first_rows,
    flag_consumption,
    hour_of_day_totals,
    hourly_rollup,
    inferred_profile,
    keep_first_per_timestamp,
    last_rows,
    non_missing,
    parse_timestamps,
    rejected_values,
    table_shape,
    timestamp_first,
)
from wattline.plans.job import JobReport, enriched_readings, materialize, run
from wattline.schema import (
    CLEAN_SCHEMA,
    CONSUMPTION,
    CONSUMPTION_FLAG,
    DAY,
    ENRICHED_SCHEMA,
    NUMERIC_COLUMNS,
    PEAK_FLAGS,
    PURCHASE,
    TIMESTAMP,
)
from wattline.session import stateful_settings, work_folder
from wattline.sources import (
    as_readings,
    as_text,
    events_as_readings,
    export_readings,
    first_of_files,
    last_of_files,
    load_readings,
    read_events,
    read_export,
    read_quarantine,
    stream_readings,
)
from wattline.sources.delimited import text_options
from wattline.sources.files import remove
from wattline.sources.tables import EVENT_ID, messy_readings, write_messy_files, write_noted_files
from wattline.streaming import (
    closed_daily_maxima,
    first_within_watermark,
    ingest,
    read_clean,
    read_enriched,
    refresh,
    running_hour_totals,
    typed_rows,
)

Query = Callable[[SparkSession, str], DataFrame]

ORDER = [EVENT_ID]
WATERMARK = "10 minutes"
#: Into how many stores the 24 keys of the running totals go, and the open days and minutes of the maxima.
HOUR_TOTALS_PARTITIONS, DAILY_MAXIMA_PARTITIONS = 2, 8
ARRIVALS = 3

_ID = T.StructField(EVENT_ID, T.LongType())
CLEAN_WITH_ID = T.StructType([*CLEAN_SCHEMA.fields, _ID])


# Raw rows and single cleaning steps


def raw_readings(spark, folder):
    return events_as_readings(spark, folder)


def missing_tokens(spark, folder):
    raw = raw_readings(spark, folder)
    return raw.withColumns({c: missing_to_null(F.col(c)) for c in raw.columns if c != EVENT_ID})


def sentinel_filtered(spark, folder):
    return drop_sentinel_rows(raw_readings(spark, folder))


def numeric_coerced(spark, folder):
    return coerce_numbers(raw_readings(spark, folder)).select(EVENT_ID, *NUMERIC_COLUMNS)


def rejected_value_counts(spark, folder):
    return rejected_values(raw_readings(spark, folder))


def date_dropped(spark, folder):
    return drop_redundant_date(raw_readings(spark, folder))


def timestamp_parsed(spark, folder):
    parsed = raw_readings(spark, folder).transform(parse_timestamps)
    return parsed.transform(drop_missing_timestamps).select(EVENT_ID, TIMESTAMP)


def timestamp_formats(spark, folder):
    """Day-first and compact text, understood through formats named by the caller."""
    text = F.col(TIMESTAMP)
    year, month, day = (F.substring(text, *at) for at in ((1, 4), (6, 2), (9, 2)))
    compact = F.concat(year, month, day)
    day_first = F.concat_ws("/", day, month, year)
    raw = raw_readings(spark, folder).withColumn(
        TIMESTAMP,
        F.when(F.col(EVENT_ID) % 2 == 0, compact).otherwise(
            F.concat_ws(" ", day_first, F.substring(text, 12, 5))
        ),
    )
    formats = ("dd/MM/yyyy HH:mm", "yyyyMMdd")
    return parse_timestamps(raw, formats).select(EVENT_ID, TIMESTAMP)


def first_per_timestamp(spark, folder):
    return (
        sentinel_filtered(spark, folder)
        .transform(parse_timestamps)
        .transform(drop_missing_timestamps)
        .transform(keep_first_per_timestamp, ORDER)
        .transform(timestamp_first)
        .select(TIMESTAMP, EVENT_ID)
    )


def consumption_flagged(spark, folder):
    flagged = sentinel_filtered(spark, folder).transform(coerce_numbers).transform(flag_consumption)
    return flagged.select(EVENT_ID, CONSUMPTION, CONSUMPTION_FLAG)


# Cleaning and metrics as a whole


def cleaned(spark, folder):
    return clean_readings(raw_readings(spark, folder), ORDER)


def readings_with_metrics(spark, folder):
    return enriched_readings(raw_readings(spark, folder), ORDER)


def readings_with_metrics_in_one_plan(spark, folder):
    """The same by the public call alone, which writes what it uses twice."""
    return cleaned(spark, folder).transform(add_hour_metrics)


def hour_day_rollup(spark, folder):
    return hourly_rollup(cleaned(spark, folder))


def hour_totals(spark, folder):
    return hour_of_day_totals(cleaned(spark, folder))


def hour_totals_joined(spark, folder):
    return add_hour_totals(materialize(cleaned(spark, folder), "cleaned"))


def day_maxima(spark, folder):
    return daily_maxima(cleaned(spark, folder)).withColumnRenamed(DAY, "day")


def daily_peak_flags(spark, folder):
    flagged = add_peak_flags(materialize(cleaned(spark, folder), "cleaned"))
    return flagged.select(TIMESTAMP, *PEAK_FLAGS.values())


def peak_hours(spark, folder):
    return daily_peak_hours(cleaned(spark, folder))


# Unusable, odd and missing text


def messy_missing_tokens(spark, folder):
    raw = messy_readings(spark, folder)
    return raw.withColumns({c: missing_to_null(F.col(c)) for c in raw.columns if c != EVENT_ID})


def messy_rejected_values(spark, folder):
    return rejected_values(messy_readings(spark, folder))


def messy_clean_readings(spark, folder):
    return clean_readings(messy_readings(spark, folder), ORDER)


def messy_metrics(spark, folder):
    return messy_clean_readings(spark, folder).transform(add_hour_metrics)


# Exploration


def profile(spark, folder):
    return column_profile(missing_tokens(spark, folder))


def inferred_types(spark, folder):
    """The profile of a table of text with the types that its values have."""
    raw = messy_readings(spark, folder)
    return inferred_profile(raw.withColumns({c: missing_to_null(F.col(c)) for c in raw.columns if c != EVENT_ID}))


def non_null_consumption(spark, folder):
    return non_missing(missing_tokens(spark, folder), CONSUMPTION)


def head_rows(spark, folder):
    return as_readings(first_rows(read_events(spark, folder), 10, ORDER))


def tail_rows(spark, folder):
    """The rows are picked first, so only ten of them are turned into text."""
    return as_readings(last_rows(read_events(spark, folder), 10, ORDER))


# Files


def _as_files(spark, folder) -> str:
    """The raw readings as delimited files whose names follow the sequence."""
    path = work_folder(spark, "raw")
    raw = raw_readings(spark, folder).orderBy(*ORDER)
    raw.write.options(**text_options(";")).csv(path)
    return path


def load_metrics(spark, folder):
    return table_shape(load_readings(spark, _as_files(spark, folder)))


def loaded_from_files(spark, folder):
    loaded = load_readings(spark, _as_files(spark, folder))
    return loaded.select(F.col(EVENT_ID).cast("bigint"), *loaded.columns[1:-1])


def csv_round_trip(spark, folder):
    """The whole job from delimited files to delimited files, read back."""
    target = work_folder(spark, "export")
    run(spark, _as_files(spark, folder), target)
    schema = T.StructType([ENRICHED_SCHEMA.fields[0], _ID, *ENRICHED_SCHEMA.fields[1:]])
    return read_export(spark, target, schema=schema)


def quarantined_lines(spark, folder):
    """Lines with too many fields or an open quote."""
    path = write_messy_files(spark, folder, work_folder(spark, "messy"))
    return read_quarantine(spark, path).select("line")


def job_counts(spark, folder):
    """What the whole job reports about files with malformed lines and unusable timestamps."""
    path = write_messy_files(spark, folder, work_folder(spark, "messy"))
    report = run(spark, path, work_folder(spark, "export"), format="parquet", ordered=False)
    names = [name for name in JobReport.__dataclass_fields__ if name.endswith("_rows")]
    schema = T.StructType([T.StructField(name, T.LongType()) for name in names])
    return spark.createDataFrame([tuple(getattr(report, name) for name in names)], schema)


def multiline_readings(spark, folder):
    """Readings whose notes hold line breaks, from files that are read in splits."""
    path = write_noted_files(spark, folder, work_folder(spark, "noted"))
    loaded = load_readings(spark, path, multiline=True)
    return loaded.select(F.col(EVENT_ID).cast("bigint"), *loaded.columns[1:-1])


def file_head(spark, folder):
    """The first rows of files, without opening more of them than hold these."""
    rows = first_of_files(spark, _as_files(spark, folder))
    return rows.select(F.col(EVENT_ID).cast("bigint"), *rows.columns[1:-1])


def file_tail(spark, folder):
    rows = last_of_files(spark, _as_files(spark, folder))
    return rows.select(F.col(EVENT_ID).cast("bigint"), *rows.columns[1:-1])


def snapshot_export(spark, folder):
    """A result published as a snapshot in place of an earlier one, as a reader finds it."""
    target = work_folder(spark, "export")
    enriched = readings_with_metrics(spark, folder)
    for rows in (enriched.where(F.col(EVENT_ID) % 2 == 0), enriched):
        export_readings(rows, target, snapshots=2)
    schema = T.StructType([ENRICHED_SCHEMA.fields[0], _ID, *ENRICHED_SCHEMA.fields[1:]])
    return read_export(spark, target, schema=schema)


def parquet_round_trip(spark, folder):
    target = work_folder(spark, "export")
    enriched = readings_with_metrics(spark, folder)
    export_readings(enriched, target, format="parquet", ordered=False)
    return spark.read.schema(enriched.schema).parquet(target)


def export_text(spark, folder):
    """The values of an export as the text that is written."""
    text = as_text(readings_with_metrics(spark, folder))
    return text.select(TIMESTAMP, CONSUMPTION_FLAG, *PEAK_FLAGS.values())


# Streams: the readings arrive in parts by event_id, each part is one recurring run


def _arrivals(raw: DataFrame, feed: str) -> Iterator[DataFrame]:
    """Put one part after another into a folder; gives the folder as a stream each time."""
    spark = raw.sparkSession
    first, last = raw.agg(F.min(EVENT_ID), F.max(EVENT_ID)).first()
    step = (last - first) // ARRIVALS + 1
    for start in range(first, last + 1, step):
        part = raw.where(F.col(EVENT_ID).between(start, start + step - 1))
        part.write.mode("append").parquet(feed)
        yield spark.readStream.schema(raw.schema).parquet(feed)


def _streamed_tier(spark, folder) -> str:
    tier = work_folder(spark, "tier")
    for stream in _arrivals(raw_readings(spark, folder), work_folder(spark, "feed")):
        ingest(stream, tier, order_by=ORDER, every=None).awaitTermination()
    return tier


def stream_clean_readings(spark, folder):
    return read_clean(spark, _streamed_tier(spark, folder), CLEAN_WITH_ID)


def stream_metrics(spark, folder):
    return read_enriched(spark, _streamed_tier(spark, folder), CLEAN_WITH_ID)


def stream_export(spark, folder):
    """The enriched tier as delimited files, published anew after every arrival."""
    tier, target = work_folder(spark, "tier"), work_folder(spark, "export")

    def publish(session: SparkSession) -> None:
        export_readings(read_enriched(session, tier, CLEAN_WITH_ID), target)

    for stream in _arrivals(raw_readings(spark, folder), work_folder(spark, "feed")):
        ingest(stream, tier, order_by=ORDER, every=None, after=publish).awaitTermination()
    schema = T.StructType([*CLEAN_WITH_ID.fields, *ENRICHED_SCHEMA.fields[len(CLEAN_SCHEMA) :]])
    return read_export(spark, target, schema=schema)


#: The readings of files: the sequence is text like every column.
_TEXT_ID = T.StructType([*CLEAN_SCHEMA.fields, T.StructField(EVENT_ID, T.StringType())])


def _file_parts(raw: DataFrame) -> list[DataFrame]:
    """The readings cut into parts by their sequence."""
    first, last = raw.agg(F.min(EVENT_ID), F.max(EVENT_ID)).first()
    step = (last - first) // ARRIVALS + 1
    return [raw.where(F.col(EVENT_ID).between(s, s + step - 1)) for s in range(first, last + 1, step)]


def _write_part(rows: DataFrame, path: str) -> None:
    rows.orderBy(*ORDER).write.mode("overwrite").options(**text_options(";")).csv(path)


def _clean_of_files(spark: SparkSession, tier: str) -> DataFrame:
    return read_clean(spark, tier, _TEXT_ID).withColumn(EVENT_ID, F.col(EVENT_ID).cast("bigint"))


def stream_late_files(spark, folder, arrivals=(2, 0, 1)):
    """Files that arrive out of order: of rows with one timestamp the first by file name counts all the same."""
    tier, feed = work_folder(spark, "tier"), work_folder(spark, "feed")
    raw = raw_readings(spark, folder)
    parts = _file_parts(raw)
    for number in arrivals:
        _write_part(parts[number], f"{feed}/part-{number}")
        ingest(stream_readings(spark, f"{feed}/*", raw.columns), tier, every=None).awaitTermination()
    return _clean_of_files(spark, tier)


def _rewritten_tier(spark, folder) -> str:
    """A tier whose files were, at first, in part others.

    An extra file that comes first has a row for every third timestamp, and the second file has other values and some of the
    third one's rows. Then the extra file goes, the second is rewritten and the third is written
    once more as it was.
    """
    tier, feed = work_folder(spark, "tier"), work_folder(spark, "feed")
    raw = raw_readings(spark, folder)
    parts = _file_parts(raw)
    other = raw.withColumn(PURCHASE, F.lit("999999"))
    _write_part(other.where(F.col(EVENT_ID) % 3 == 0), f"{feed}/extra")
    for number, rows in enumerate(parts):
        first = other.where(F.col(EVENT_ID) % 2 == 0).join(rows.select(EVENT_ID), EVENT_ID, "left_anti")
        _write_part(first if number == 1 else rows, f"{feed}/part-{number}")
    refresh(spark, f"{feed}/*", tier)
    remove(spark, f"{feed}/extra")
    for number in (1, 2):
        _write_part(parts[number], f"{feed}/part-{number}")
    refresh(spark, f"{feed}/*", tier)
    return tier


def stream_rewritten_file(spark, folder):
    """A tier after one of its files was rewritten and one removed: as if only the last contents had been there."""
    return _clean_of_files(spark, _rewritten_tier(spark, folder))


def stream_rewritten_metrics(spark, folder):
    """Totals and peak flags of that tier."""
    enriched = read_enriched(spark, _rewritten_tier(spark, folder), _TEXT_ID)
    return enriched.withColumn(EVENT_ID, F.col(EVENT_ID).cast("bigint"))


def stream_hour_totals(spark, folder):
    """Totals over all typed rows, duplicates included."""
    out, checkpoint = work_folder(spark, "totals"), work_folder(spark, "checkpoint")
    with stateful_settings(spark, HOUR_TOTALS_PARTITIONS):
        for stream in _arrivals(raw_readings(spark, folder), work_folder(spark, "feed")):
            (
                running_hour_totals(typed_rows(stream))
                .writeStream.outputMode("complete")
                .foreachBatch(lambda totals, _: totals.write.mode("overwrite").parquet(out))
                .option("checkpointLocation", checkpoint)
                .trigger(availableNow=True)
                .start()
                .awaitTermination()
            )
    return spark.read.parquet(out)


def stream_daily_maxima(spark, folder):
    """Maxima of the days the watermark has closed; a day still open is not given out."""
    out, checkpoint = work_folder(spark, "maxima"), work_folder(spark, "checkpoint")
    raw = as_readings(read_events(spark, folder), to_the_minute=False)
    with stateful_settings(spark, DAILY_MAXIMA_PARTITIONS):
        for stream in _arrivals(raw, work_folder(spark, "feed")):
            unique = first_within_watermark(typed_rows(stream), WATERMARK, ORDER)
            (
                closed_daily_maxima(unique)
                .writeStream.outputMode("append")
                .format("parquet")
                .option("checkpointLocation", checkpoint)
                .trigger(availableNow=True)
                .start(out)
                .awaitTermination()
            )
    schema = T.StructType([T.StructField("day", T.DateType())])
    for name in ("max_grid_purchase", "max_grid_feedin"):
        schema = schema.add(name, T.LongType())
    return spark.read.schema(schema).parquet(out)


QUERIES: dict[str, Query] = {
    "readings_with_metrics": readings_with_metrics,
    "readings_with_metrics_in_one_plan": readings_with_metrics_in_one_plan,
    "raw_readings": raw_readings,
    "missing_tokens": missing_tokens,
    "sentinel_filtered": sentinel_filtered,
    "numeric_coerced": numeric_coerced,
    "rejected_values": rejected_value_counts,
    "date_dropped": date_dropped,
    "timestamp_parsed": timestamp_parsed,
    "timestamp_formats": timestamp_formats,
    "first_per_timestamp": first_per_timestamp,
    "consumption_flagged": consumption_flagged,
    "clean_readings": cleaned,
    "hourly_rollup": hour_day_rollup,
    "hour_of_day_totals": hour_totals,
    "hour_totals_joined": hour_totals_joined,
    "daily_maxima": day_maxima,
    "daily_peak_flags": daily_peak_flags,
    "daily_peak_hours": peak_hours,
    "messy_missing_tokens": messy_missing_tokens,
    "messy_rejected_values": messy_rejected_values,
    "messy_clean_readings": messy_clean_readings,
    "messy_metrics": messy_metrics,
    "column_profile": profile,
    "inferred_profile": inferred_types,
    "non_null_consumption": non_null_consumption,
    "head_rows": head_rows,
    "tail_rows": tail_rows,
    "load_metrics": load_metrics,
    "loaded_from_files": loaded_from_files,
    "csv_round_trip": csv_round_trip,
    "quarantined_lines": quarantined_lines,
    "job_counts": job_counts,
    "multiline_readings": multiline_readings,
    "file_head": file_head,
    "file_tail": file_tail,
    "snapshot_export": snapshot_export,
    "parquet_round_trip": parquet_round_trip,
    "export_text": export_text,
    "stream_clean_readings": stream_clean_readings,
    "stream_metrics": stream_metrics,
    "stream_export": stream_export,
    "stream_late_files": stream_late_files,
    "stream_rewritten_file": stream_rewritten_file,
    "stream_rewritten_metrics": stream_rewritten_metrics,
    "stream_hour_totals": stream_hour_totals,
    "stream_daily_maxima": stream_daily_maxima,
}
