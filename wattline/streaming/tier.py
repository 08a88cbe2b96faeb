"""Recurring refresh: new files are cleaned into a tier whose committed state equals one batch run.

A tier is a folder::

    clean/reading_day=D/batch_id=N/    the cleaned rows of micro-batch N, each with its place in the source
    rollup/reading_day=D/batch_id=N/   per hour: sums, maxima, and which seconds have rows
    hidden/reading_day=D/batch_id=N/   rows that another one with their timestamp comes before, or no longer
    ledger/batch_id=N/                 the files the batch took, took again or found gone (see ``refresh``)
    quarantine/batch_id=N/             malformed lines of the batch, if the stream keeps them
    commits/batch_id=N/                counts of the batch, written last
    attempts/N                         a refresh that has begun and not committed
    checkpoint/                        progress of the stream

Of the rows of one timestamp the first by source order counts, whatever order they arrived in: a
batch stores what it brings, and where a timestamp has several rows it notes which of them are
hidden. A row shows again when the rows before it go with the file they came from. Readers take the
rows of committed batches, without the hidden ones and those of files that were read again since.

Whether a batch meets earlier rows is told by bitmaps, one bit per second of an hour, that its parts
hold: where none of its bits was set before, no earlier row is read. Fractions of a second have
bitmaps of their own, which tell less; where they meet, rows are compared.

A micro-batch replaces only partitions with its own number and looks only at lower ones, so a batch
that runs again after a failure leaves the tier as if it had run once, and what a failed one left
behind is not seen. Every batch takes the same path, the first like any other, over few days or
many. ``compact`` merges the parts of many batches.

The checkpoint belongs to the tier: start a new stream with a new tier.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wattline.functions import calendar_day, hour_of_day
from wattline.operators import add_hour_metrics, clean_readings
from wattline.operators.metrics import DAILY_MAXIMA, rollup_measures
from wattline.schema import CLEAN_SCHEMA, DAY, EARLIEST, GRID_MEASURES, HOUR, MAX_DAYS, READ_ORDER, TIMESTAMP, TOTALS
from wattline.session import materialize, work_folder
from wattline.sources.delimited import QUARANTINED, is_missing_path, number_lines
from wattline.sources.files import names_in, remove

BATCH = "batch_id"
#: A row's place in its source, by which the first of several rows with one timestamp is told.
PLACE = "_place"
FILE = "file"

SEEN, SEEN_FRACTIONS = "seen", "seen_fractions"
RESET, SHOWN = "reset", "shown"
HIDDEN = "hidden"
_BITMAP_BITS = 32768

COMMIT_SCHEMA = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in ("accepted_count", "quarantined_count", "without_timestamp_count", BATCH)
    ]
)
#: A commit as stored: the number of the batch besides that of the folder, which changes in a compaction.
_OF_BATCH = "of_batch"
_STORED_COMMIT = T.StructType([*COMMIT_SCHEMA.fields[:-1], T.StructField(_OF_BATCH, T.LongType()), COMMIT_SCHEMA.fields[-1]])

PART_SCHEMA = T.StructType(
    [T.StructField(DAY, T.DateType()), T.StructField(HOUR, T.IntegerType())]
    + [T.StructField(name, T.LongType()) for name in (*TOTALS.values(), *DAILY_MAXIMA.values(), SHOWN)]
    + [T.StructField(name, T.BinaryType()) for name in (SEEN, SEEN_FRACTIONS)]
    + [T.StructField(RESET, T.BooleanType()), T.StructField(BATCH, T.LongType())]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField(FILE, T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("checksum", T.StringType()),
        T.StructField("present", T.BooleanType()),
        # The batch whose rows of the file count; earlier ones are those of older contents.
        T.StructField("content", T.LongType()),
        T.StructField("days", T.ArrayType(T.DateType())),
        T.StructField(BATCH, T.LongType()),
    ]
)


@dataclass(frozen=True)
class State:
    """What is committed: the number of the last compaction (0 if none), of the last batch (or -1), and gaps."""

    base: int
    last: int
    failed: tuple[int, ...] = ()

    def includes(self, batch: Column) -> Column:
        since = batch.between(-self.base if self.base else 0, self.last)
        if self.failed:
            since &= ~batch.isin(*self.failed)
        return since | (batch == self.base) if self.base else since

    def before(self, batch_id: int) -> State:
        return State(self.base, min(self.last, batch_id - 1), self.failed)


def ingest(
    stream: DataFrame,
    tier: str,
    *,
    order_by: Sequence[str] = (READ_ORDER,),
    formats: Iterable[str] = (),
    every: str | None = "5 minutes",
    after: Callable[[SparkSession], object] | None = None,
) -> StreamingQuery:
    """Start cleaning a stream of raw readings into a tier.

    ``every`` is the refresh period; ``None`` processes what is there and stops. Of several rows with
    one timestamp the first by ``order_by`` counts, in a batch and over all of them. ``after`` is
    called when a batch is committed, for example to export the tier; it runs again if the batch
    does. A stream takes a file once; ``refresh`` also sees files that change.
    """
    formats = tuple(formats)

    def accept(batch: DataFrame, batch_id: int) -> None:
        write_batch(number_lines(batch), tier, batch_id, order_by, formats)
        if after is not None:
            after(batch.sparkSession)

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        stream.writeStream.foreachBatch(accept)
        .option("checkpointLocation", f"{tier}/checkpoint")
        .trigger(**trigger)
        .start()
    )


def write_batch(
    raw: DataFrame,
    tier: str,
    batch_id: int,
    order_by: Sequence[str] = (READ_ORDER,),
    formats: Iterable[str] = (),
    ledger: DataFrame | None = None,
    replaced_days: Iterable[dt.date] = (),
) -> None:
    """Add one batch of raw readings to a tier; safe to repeat with the same number.

    ``ledger`` (of ``LEDGER_SCHEMA`` but the days and the batch) says which files the batch brings in
    place of earlier contents; ``replaced_days`` are the days that those had rows of.
    """
    spark = raw.sparkSession
    state = committed(spark, tier).before(batch_id)
    quarantined = Observation()
    aside = QUARANTINED in raw.columns
    if aside:
        raw = _set_aside(raw, tier, batch_id, quarantined)
    by_file = tuple(order_by) == (READ_ORDER,)
    place = F.col(READ_ORDER) if by_file else F.struct(*order_by)
    dropped, stored = Observation(), Observation()
    # Of a file that may go again every first row is kept, not only that of the whole batch.
    rows = clean_readings(
        raw.withColumn(PLACE, place), order_by, formats, dropped, (f"{PLACE}.{FILE}",) if by_file else ()
    )
    rows = rows.withColumns({DAY: calendar_day(F.col(TIMESTAMP)), BATCH: F.lit(batch_id).cast("bigint")})
    schema = rows.schema
    # Rebalancing brings the rows of a day together, so a day gets few files, and splits a day that is large.
    # What is observed below a shuffle is lost if the shuffle turns out empty.
    rows = rows.hint("rebalance", DAY).observe(stored, F.count(F.lit(1)).alias("rows"), *_day_bits())
    _replace(rows, f"{tier}/clean")
    days = _days_of(stored)
    hidden = 0
    replaced = set(replaced_days)
    if days or replaced:
        folder = work_folder(spark, "batch")
        mine = _read_parts(spark, f"{tier}/clean", days, [batch_id], schema)
        parts = _hour_parts(mine).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        parts = materialize(parts, "parts", folder)
        met = _met_hours(spark, tier, parts, days, state) | {day: set(range(24)) for day in replaced}
        if met:
            old = None
            if ledger is not None:
                old = ledger.select(FILE, F.col("content").alias("since"))
            hidden, parts = _settle(spark, tier, batch_id, schema, parts, met, replaced, state, old, folder)
        # Without this every task has hours of every day, and writes a file for each.
        _replace(parts.hint("rebalance", DAY), f"{tier}/rollup")
        remove(spark, folder)
    if ledger is not None:
        _write_ledger(ledger, tier, batch_id, schema, days)
    counts = [
        (
            stored.get["rows"] - hidden,
            quarantined.get["lines"] if aside else 0,
            dropped.get["without_timestamp_count"],
            batch_id,
            batch_id,
        )
    ]
    _replace(spark.createDataFrame(counts, _STORED_COMMIT).coalesce(1), f"{tier}/commits", BATCH)


def _set_aside(raw: DataFrame, tier: str, batch_id: int, count: Observation) -> DataFrame:
    """Writes the malformed lines of a batch, counting them; gives the other rows."""
    lines = raw.where(F.col(QUARANTINED).isNotNull())
    lines = lines.select(F.col(READ_ORDER)[FILE].alias(FILE), F.col(QUARANTINED).alias("line"))
    lines = lines.observe(count, F.count(F.lit(1)).alias("lines"))
    lines.write.mode("overwrite").parquet(f"{tier}/quarantine/{BATCH}={batch_id}")
    return raw.where(F.col(QUARANTINED).isNull()).drop(QUARANTINED)


# Which days and seconds have rows


def _day_bits() -> list[Column]:
    """Bitmaps of the days that occur, counted from the first one a timestamp can have."""
    number = F.datediff(DAY, F.lit(EARLIEST[:10]).cast("date"))
    bitmap = F.floor(number / _BITMAP_BITS)
    return [
        F.bitmap_construct_agg(F.when(bitmap == i, number % _BITMAP_BITS)).alias(f"days{i}")
        for i in range(MAX_DAYS // _BITMAP_BITS + 1)
    ]


def _days_of(observed: Observation) -> list[dt.date]:
    first = dt.date.fromisoformat(EARLIEST[:10])
    days = []
    for i in range(MAX_DAYS // _BITMAP_BITS + 1):
        for byte, bits in enumerate(observed.get[f"days{i}"] or b""):
            for bit in range(8):
                if bits >> bit & 1:
                    days.append(first + dt.timedelta(i * _BITMAP_BITS + 8 * byte + bit))
    return days


def _hour_parts(rows: DataFrame, shown: Column | None = None) -> DataFrame:
    """Per day and hour: sums and maxima of the rows that are shown, and the seconds of all rows as bits."""
    ts = F.col(TIMESTAMP)
    second = F.date_part(F.lit("SECOND"), ts)
    place = F.minute(ts) * 60 + F.floor(second).cast("int")
    whole = second == F.floor(second)
    if shown is None:
        shown = F.lit(True)
    measures = [F.when(shown, F.col(c)).alias(c) for c in GRID_MEASURES]
    return (
        rows.select(
            calendar_day(ts).alias(DAY),
            hour_of_day(ts).alias(HOUR),
            *measures,
            shown.alias(SHOWN),
            F.when(whole, place).alias(SEEN),
            F.when(~whole, place).alias(SEEN_FRACTIONS),
        )
        .groupBy(DAY, HOUR)
        .agg(
            *rollup_measures(),
            F.count_if(SHOWN).alias(SHOWN),
            F.bitmap_construct_agg(SEEN).alias(SEEN),
            F.bitmap_construct_agg(SEEN_FRACTIONS).alias(SEEN_FRACTIONS),
            F.lit(False).alias(RESET),
        )
    )


def _met_hours(
    spark: SparkSession, tier: str, mine: DataFrame, days: Sequence[dt.date], state: State
) -> dict[dt.date, set[int]]:
    """The hours in which a timestamp of the batch may have more than one row, from the parts alone.

    A batch that brings as many new bits as rows meets nothing. The days of the calendar bound what
    the driver sees.
    """
    earlier = _read_days(spark, f"{tier}/rollup", days, PART_SCHEMA)
    is_mine = F.col("mine")
    both = mine.withColumn("mine", F.lit(True))
    if earlier is not None:
        earlier = earlier.where(state.includes(F.col(BATCH))).withColumn("mine", F.lit(False))
        both = both.unionByName(earlier)

    def bits(of: Column) -> Column:
        kinds = [F.when(of, F.col(c)) for c in (SEEN, SEEN_FRACTIONS)]
        counts = [F.coalesce(F.bitmap_count(F.bitmap_or_agg(kind)), F.lit(0)) for kind in kinds]
        return counts[0] + counts[1]

    met = (
        both.groupBy(DAY, HOUR)
        .agg(F.sum(F.when(is_mine, F.col(SHOWN))).alias("rows"), (bits(F.lit(True)) - bits(~is_mine)).alias("new"))
        .where(F.col("rows") > F.col("new"))
        .groupBy(DAY)
        .agg(F.collect_set(HOUR).alias("hours"))
    )
    return {r[DAY]: set(r["hours"]) for r in met.collect()}


# Timestamps with several rows


def _settle(
    spark: SparkSession,
    tier: str,
    batch_id: int,
    schema: T.StructType,
    parts: DataFrame,
    met: dict[dt.date, set[int]],
    replaced: set[dt.date],
    state: State,
    old: DataFrame | None,
    folder: str,
) -> tuple[int, DataFrame]:
    """Notes which rows of these hours are hidden; gives how many of the batch are, and its parts with these hours anew.

    Of earlier rows the timestamp, the place and the two measures are read, of these days alone.
    """
    hours = spark.createDataFrame(
        [(day, hour, day in replaced) for day, found in met.items() for hour in sorted(found)],
        f"{DAY} date, {HOUR} int, replaced boolean",
    )
    rows = _read_days(spark, f"{tier}/clean", met, schema)
    if rows is None:
        return 0, parts
    rows = live_rows(rows, tier, state, or_batch=batch_id, old=old)
    rows = rows.select(TIMESTAMP, PLACE, *GRID_MEASURES, DAY, BATCH, hour_of_day(F.col(TIMESTAMP)).alias(HOUR))
    rows = rows.join(hours.drop("replaced"), [DAY, HOUR], "left_semi")
    first = F.row_number().over(Window.partitionBy(TIMESTAMP).orderBy(PLACE, BATCH)) == 1
    was = hidden_rows(spark, tier, state, schema[PLACE], met)
    rows = rows.withColumn(HIDDEN, ~first)
    if was is None:
        rows = rows.withColumn("was", F.lit(False))
    else:
        was = was.select(TIMESTAMP, PLACE, F.col("of_batch").alias(BATCH), F.lit(True).alias("was"))
        rows = rows.join(was, [TIMESTAMP, PLACE, BATCH], "left").withColumn("was", F.coalesce("was", F.lit(False)))
    rows = materialize(rows, "rows", folder)

    notes = rows.where(F.col(HIDDEN) != F.col("was")).select(
        TIMESTAMP, PLACE, F.col(BATCH).alias("of_batch"), HIDDEN, DAY, F.lit(batch_id).cast("bigint").alias(BATCH)
    )
    mine = F.col(BATCH) == batch_id
    noted = Observation()
    late = F.count_if((F.col("of_batch") == batch_id) & F.col(HIDDEN)).alias("late")
    _replace(notes.hint("rebalance", DAY).observe(noted, late), f"{tier}/hidden")

    # Hours in which nothing shows that did not before need no part; the others start anew.
    changed = rows.groupBy(DAY, HOUR).agg(
        F.max((F.col(HIDDEN) != F.col("was")) & ~mine | mine & ~F.col(HIDDEN)).alias("changed")
    )
    anew = (
        hours.join(changed, [DAY, HOUR], "left")
        .where(F.col("replaced") | F.coalesce("changed", F.lit(False)))
        .select(DAY, HOUR)
        .join(_hour_parts(rows, ~F.col(HIDDEN)).drop(RESET), [DAY, HOUR], "left")
        .withColumns({SHOWN: F.coalesce(SHOWN, F.lit(0)), RESET: F.lit(True), BATCH: F.lit(batch_id).cast("bigint")})
    )
    kept = parts.join(hours, [DAY, HOUR], "left_anti")
    return noted.get["late"], kept.unionByName(anew.select(*kept.columns))


def hidden_rows(
    spark: SparkSession, tier: str, state: State, place: T.StructField, days: Iterable[dt.date] | None = None
) -> DataFrame | None:
    """The rows (timestamp, place, batch of the row, day) that the last note about them hides; None without notes."""
    path = f"{tier}/hidden"
    schema = T.StructType(
        [
            T.StructField(TIMESTAMP, T.TimestampNTZType()),
            place,
            T.StructField("of_batch", T.LongType()),
            T.StructField(HIDDEN, T.BooleanType()),
            T.StructField(DAY, T.DateType()),
            T.StructField(BATCH, T.LongType()),
        ]
    )
    if days is not None:
        notes = _read_days(spark, path, days, schema)
    else:
        notes = spark.read.schema(schema).parquet(path) if _day_folders(spark, path) else None
    if notes is None:
        return None
    return (
        notes.where(state.includes(F.col(BATCH)))
        .groupBy(TIMESTAMP, PLACE, "of_batch", DAY)
        .agg(F.max_by(HIDDEN, BATCH).alias(HIDDEN))
        .where(HIDDEN)
    )


def live_rows(
    rows: DataFrame, tier: str, state: State, or_batch: int | None = None, old: DataFrame | None = None
) -> DataFrame:
    """Rows of committed batches (or of the one named), without those of contents that files no longer have."""
    included = state.includes(F.col(BATCH))
    if or_batch is not None:
        included |= F.col(BATCH) == or_batch
    rows = rows.where(included)
    files = latest_files(rows.sparkSession, tier, state)
    if files is None and old is None:
        return rows
    since = [t for t in (old, None if files is None else files.select(FILE, F.col("content").alias("since"))) if t is not None]
    since = since[0] if len(since) == 1 else since[0].unionByName(since[1])
    since = since.groupBy(F.col(FILE).alias("_file")).agg(F.max("since").alias("_since"))
    gone = (F.col(f"{PLACE}.{FILE}") == F.col("_file")) & (F.col(BATCH) < F.col("_since"))
    return rows.join(since, gone, "left_anti")


def latest_files(spark: SparkSession, tier: str, state: State) -> DataFrame | None:
    """The last entry of every file that a refresh has seen; None if there was no refresh."""
    if not names_in(spark, f"{tier}/ledger"):
        return None
    entries = _read_or_empty(spark, f"{tier}/ledger", LEDGER_SCHEMA).where(state.includes(F.col(BATCH)))
    others = [c for c in LEDGER_SCHEMA.names if c not in (FILE, BATCH)]
    last = entries.groupBy(FILE).agg(F.max_by(F.struct(*others), BATCH).alias("entry"))
    return last.select(FILE, "entry.*")


def _write_ledger(ledger: DataFrame, tier: str, batch_id: int, schema: T.StructType, days: Sequence[dt.date]) -> None:
    """The entries with the days that the batch's rows of each file have; a file that did not change keeps its own."""
    spark = ledger.sparkSession
    mine = _read_parts(spark, f"{tier}/clean", days, [batch_id], schema)
    found = mine.groupBy(F.col(f"{PLACE}.{FILE}").alias(FILE)).agg(F.collect_set(DAY).alias("found"))
    entries = ledger.join(found, FILE, "left").withColumns(
        {
            "days": F.coalesce("found", "days", F.array().cast("array<date>")),
            BATCH: F.lit(batch_id).cast("bigint"),
        }
    )
    _replace(entries.select(*LEDGER_SCHEMA.names), f"{tier}/ledger", BATCH)


# Reading


def read_commits(spark: SparkSession, tier: str) -> DataFrame:
    """Per committed batch: rows accepted, lines quarantined, rows without a usable timestamp.

    Accepted rows are those shown when the batch was committed.
    """
    commits = _read_or_empty(spark, f"{tier}/commits", _STORED_COMMIT)
    commits = commits.where(committed(spark, tier).includes(F.col(BATCH)))
    return commits.drop(BATCH).withColumnRenamed(_OF_BATCH, BATCH)


def read_quarantined(spark: SparkSession, tier: str) -> DataFrame:
    """The malformed lines of all committed batches, with the file each came from.

    Of a file that was read again, the lines of its present contents.
    """
    schema = T.StructType(
        [T.StructField(FILE, T.StringType()), T.StructField("line", T.StringType()), T.StructField(BATCH, T.LongType())]
    )
    state = committed(spark, tier)
    lines = _read_or_empty(spark, f"{tier}/quarantine", schema).where(F.col(BATCH) <= state.last)
    if state.failed:
        lines = lines.where(~F.col(BATCH).isin(*state.failed))
    files = latest_files(spark, tier, state)
    if files is not None:
        since = files.select(F.col(FILE).alias("_file"), F.col("content").alias("_since"))
        lines = lines.join(since, (F.col(FILE) == F.col("_file")) & (F.col(BATCH) < F.col("_since")), "left_anti")
    return lines.drop(BATCH)


def read_clean(
    spark: SparkSession, tier: str, schema: T.StructType = CLEAN_SCHEMA
) -> DataFrame:
    """The cleaned rows of a tier. ``schema`` names pass-through columns where there are any."""
    return _clean(spark, tier, schema, committed(spark, tier))


def read_rollup(spark: SparkSession, tier: str) -> DataFrame:
    """Sums and maxima per day and hour over all committed rows."""
    return _rollup(spark, tier, committed(spark, tier))


def read_enriched(
    spark: SparkSession, tier: str, schema: T.StructType = CLEAN_SCHEMA
) -> DataFrame:
    """The tier with totals and peak flags as of now, without a shuffle of its rows.

    Where rows are hidden, these are taken out by a join, which follows their number if few.
    """
    state = committed(spark, tier)
    return add_hour_metrics(_clean(spark, tier, schema, state), _rollup(spark, tier, state))


def compact(spark: SparkSession, tier: str, schema: T.StructType = CLEAN_SCHEMA) -> None:
    """Merge the parts of all committed batches, one folder per day, and their commits into one.

    The merged rows go under a negative batch number, minus the last batch minus one, and count
    from their own commit on; readers go on seeing the parts until then. The parts they replace
    are removed afterwards, so run this when no reader still uses them, and between batches. Rows
    of contents that files no longer have go; hidden ones stay where their file may change, and go
    where rows come from a stream without files.
    """
    state = committed(spark, tier)
    base, last = state.base, state.last
    if last < 0 or -base - 1 >= last:
        return
    merged = -last - 1
    number = F.lit(merged).cast("bigint")
    stored = _stored_schema(spark, tier, schema)
    rows = live_rows(_read_or_empty(spark, f"{tier}/clean", stored), tier, state)
    was = hidden_rows(spark, tier, state, stored[PLACE])
    if was is not None:
        key = [TIMESTAMP, PLACE, "of_batch", DAY]
        rows = rows.withColumn("of_batch", F.col(BATCH)).join(was, key, "left")
        rows = rows.withColumn(HIDDEN, F.coalesce(HIDDEN, F.lit(False))).drop("of_batch")
        if FILE in _place_fields(stored):
            # A row that came twice from one place is one row.
            once = F.row_number().over(Window.partitionBy(TIMESTAMP, PLACE).orderBy(HIDDEN, BATCH)) == 1
            rows = rows.withColumn("_once", once).where("_once").drop("_once")
        else:
            rows = rows.where(~F.col(HIDDEN))
        rows = materialize(rows, "compacted")
        notes = rows.where(HIDDEN).select(
            TIMESTAMP, PLACE, number.alias("of_batch"), HIDDEN, DAY, number.alias(BATCH)
        )
        _replace(notes.hint("rebalance", DAY), f"{tier}/hidden")
        rows = rows.drop(HIDDEN)
    _replace(rows.withColumn(BATCH, number).hint("rebalance", DAY), f"{tier}/clean")
    _replace(_merged_parts(spark, tier, state).withColumn(BATCH, number).hint("rebalance", DAY), f"{tier}/rollup")
    files = latest_files(spark, tier, state)
    if files is not None:
        present = files.where("present").withColumns({"content": number, BATCH: number})
        _replace(present.select(*LEDGER_SCHEMA.names), f"{tier}/ledger", BATCH)
    commits = _read_or_empty(spark, f"{tier}/commits", _STORED_COMMIT).where(state.includes(F.col(BATCH)))
    commits = materialize(commits, "commits")
    _replace(commits.withColumn(BATCH, number).coalesce(1), f"{tier}/commits", BATCH)
    for table in ("clean", "rollup", "hidden"):
        for day in _day_folders(spark, f"{tier}/{table}"):
            _remove_batches(spark, f"{tier}/{table}/{day}", base, last, merged)
    for table in ("ledger", "commits"):
        _remove_batches(spark, f"{tier}/{table}", base, last, merged)
    for name in names_in(spark, f"{tier}/attempts"):
        if int(name) <= last:
            remove(spark, f"{tier}/attempts/{name}")


def _remove_batches(spark: SparkSession, folder: str, base: int, last: int, but: int) -> None:
    for part in names_in(spark, folder):
        name, _, found = part.partition("=")
        if name == BATCH and base <= int(found) <= last and int(found) != but:
            remove(spark, f"{folder}/{part}")


def committed(spark: SparkSession, tier: str) -> State:
    """From the names of the folders that finished batches and compactions write last: two listings."""
    numbers = {
        int(name.partition("=")[2]) for name in names_in(spark, f"{tier}/commits") if name.startswith(f"{BATCH}=")
    }
    base = min([0, *numbers])
    last = max([-1, -base - 1, *numbers])
    begun = (int(name) for name in names_in(spark, f"{tier}/attempts"))
    return State(base, last, tuple(n for n in sorted(begun) if n <= last and n not in numbers and n > -base - 1))


def _place_fields(schema: T.StructType) -> list[str]:
    return schema[PLACE].dataType.names


def _stored_schema(spark: SparkSession, tier: str, schema: T.StructType) -> T.StructType:
    """The columns of the stored rows: those named, the place as it was written, day and batch."""
    path = f"{tier}/clean"
    place: list[T.StructField] = []
    for day in _day_folders(spark, path):
        try:
            there = spark.read.parquet(f"{path}/{day}").schema.fields
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            continue  # what a failed batch has left of a folder
        place = [f for f in there if f.name == PLACE]
        break
    ends = [T.StructField(DAY, T.DateType()), T.StructField(BATCH, T.LongType())]
    return T.StructType([*schema.fields, *place, *ends])


def _clean(spark, tier: str, schema: T.StructType, state: State) -> DataFrame:
    stored = _stored_schema(spark, tier, schema)
    rows = _read_or_empty(spark, f"{tier}/clean", stored)
    if PLACE not in stored.names:
        return rows.select(*schema.names)
    rows = live_rows(rows, tier, state)
    was = hidden_rows(spark, tier, state, stored[PLACE])
    if was is not None:
        # The day prunes nothing here, but rows and notes are laid out by it.
        keys = was.select(TIMESTAMP, PLACE, F.col("of_batch").alias(BATCH), DAY)
        rows = rows.join(keys, [TIMESTAMP, PLACE, BATCH, DAY], "left_anti")
    return rows.select(*schema.names)


def _merged_parts(spark, tier: str, state: State) -> DataFrame:
    """One part per day and hour: all of them added up since the hour last started anew."""
    parts = _read_or_empty(spark, f"{tier}/rollup", PART_SCHEMA).where(state.includes(F.col(BATCH)))
    since = F.max(F.when(F.col(RESET), F.col(BATCH))).over(Window.partitionBy(DAY, HOUR))
    parts = parts.withColumn("_since", since).where(F.col("_since").isNull() | (F.col(BATCH) >= F.col("_since")))
    return parts.groupBy(DAY, HOUR).agg(
        *[F.sum(TOTALS[c]).alias(TOTALS[c]) for c in GRID_MEASURES],
        *[F.max(DAILY_MAXIMA[c]).alias(DAILY_MAXIMA[c]) for c in GRID_MEASURES],
        F.sum(SHOWN).alias(SHOWN),
        *[F.bitmap_or_agg(c).alias(c) for c in (SEEN, SEEN_FRACTIONS)],
        F.lit(False).alias(RESET),
    )


def _rollup(spark, tier: str, state: State) -> DataFrame:
    merged = _merged_parts(spark, tier, state).where(F.col(SHOWN) > 0)
    return merged.select(DAY, HOUR, *TOTALS.values(), *DAILY_MAXIMA.values())


# Folders


def _replace(rows: DataFrame, path: str, *partitions: str) -> None:
    """Write partitions, replacing exactly those that occur in the rows."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*(partitions or (DAY, BATCH)))
        .parquet(path)
    )


def _day_folders(spark: SparkSession, path: str) -> list[str]:
    return [name for name in names_in(spark, path) if name.startswith(f"{DAY}=")]


def _read_days(
    spark: SparkSession, path: str, days: Iterable[dt.date], schema: T.StructType
) -> DataFrame | None:
    """Just these days of a table: one listing of its days, then only their folders."""
    wanted = {day.isoformat() for day in days}
    there = [n for n in _day_folders(spark, path) if n.partition("=")[2] in wanted]
    if not there:
        return None
    folders = [f"{path}/{name}" for name in sorted(there)]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def _read_parts(
    spark: SparkSession, path: str, days: Sequence[dt.date], batches: Sequence[int], schema: T.StructType
) -> DataFrame:
    """Days of single batches, which must be there."""
    if not days:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/{DAY}={day.isoformat()}/{BATCH}={n}" for day in days for n in batches]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def _read(spark: SparkSession, base: str, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).option("basePath", base).parquet(path)
    except AnalysisException as error:
        if is_missing_path(error):
            return None
        raise


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    table = _read(spark, path, path, schema)
    return spark.createDataFrame([], schema) if table is None else table
