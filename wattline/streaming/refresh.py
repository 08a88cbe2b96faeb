"""A tier that follows a folder of files which may be added to, rewritten and removed.

Every refresh compares the files there are with a ledger of those it took: path, size, time and a
checksum of the contents. New files are read, files that changed are read again in place of what
they held, and the rows of files that are gone go. Rows that such rows had hidden show again. So the
tier equals one batch run over the files there are, at the cost of those that changed and of the
days they touch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattline.schema import ContractError
from wattline.session import sized_for
from wattline.sources.delimited import empty_readings, is_missing_path, load_readings
from wattline.sources.files import create_marker, files_at, names_in, remove
from wattline.streaming.tier import FILE, LEDGER_SCHEMA, committed, latest_files, write_batch

#: Hashes are cut to so many bits, and taken modulo a prime, so that sums of their products fit a BIGINT.
_HASH_BITS, _PRIME = 24, 2**31 - 1


def present_files(spark: SparkSession, source: str | list[str]) -> DataFrame:
    """The files of a source; none if there is no such path."""
    try:
        return files_at(spark, source)
    except AnalysisException as error:
        if is_missing_path(error):
            return spark.createDataFrame([], f"{FILE} string, path string, size long, modified timestamp")
        raise


def checksums(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A checksum per file of its lines and their order: file, checksum; files without lines have none.

    Lines of a split are numbered by an id that counts on through a task, so a line's number is the
    id less the split's least one. Sum(hash * number) is taken from sums of hash * id and of hash,
    which combine before the shuffle. Splits are combined by their starts: with other split sizes a
    file has another checksum, and is then read again.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias("start"),
        F.xxhash64("value").alias("hash"),
        F.monotonically_increasing_id().alias("id"),
    )
    part = F.col("hash").bitwiseAND(F.lit(2**_HASH_BITS - 1))
    # Ids of one task share their upper bits; the lower 33 count its rows.
    number = F.col("id").bitwiseAND(F.lit(2**33 - 1))
    splits = (
        lines.groupBy(FILE, "start")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.bit_xor("hash").alias("all"),
            F.sum(part).alias("hashes"),
            F.sum(part * (number % _PRIME) % _PRIME).alias("placed"),
            F.min(number).alias("least"),
        )
        .withColumn(
            "placed",
            F.pmod(F.col("placed") - (F.col("least") % _PRIME) * (F.col("hashes") % _PRIME) % _PRIME, F.lit(_PRIME)),
        )
    )
    each = F.xxhash64("start", "lines", "all", "hashes", "placed")
    return splits.groupBy(FILE).agg(
        F.concat_ws("-", F.sum("lines"), F.hex(F.bit_xor(each))).alias("checksum")
    )


def changes(spark: SparkSession, source: str | list[str], tier: str) -> DataFrame:
    """The files that are new, differ in size or time from their entry, or are gone, with that entry."""
    entries = latest_files(spark, tier, committed(spark, tier))
    if entries is None:
        entries = spark.createDataFrame([], LEDGER_SCHEMA).drop("batch_id")
    known = entries.where("present").withColumnsRenamed(
        {c: f"old_{c}" for c in ("path", "size", "modified", "checksum")}
    )
    both = present_files(spark, source).join(known, FILE, "full")
    new = F.col("present").isNull()
    gone = F.col("path").isNull()
    differs = (F.col("size") != F.col("old_size")) | (F.col("modified") != F.col("old_modified"))
    return both.where(new | gone | differs)


def refresh(
    spark: SparkSession,
    source: str | list[str],
    tier: str,
    sep: str = ";",
    *,
    formats: Iterable[str] = (),
    columns: list[str] | None = None,
    strict: bool = False,
) -> bool:
    """Bring a tier up to date with the files of ``source``; False if none of them has changed.

    A file is read again if its size or its checksum is another than the ledger's. One that was only
    touched gets a new entry and nothing else. Malformed lines are set aside and counted. A refresh
    that fails leaves the tier as it was; the next one starts over with a number of its own. One
    refresh at a time.
    """
    found = changes(spark, source, tier).collect()  # a row per file that changed
    if not found:
        return False
    there = [r for r in found if r["path"] is not None]
    sums: dict[str, str] = {}
    if there:
        sums = {r[FILE]: r["checksum"] for r in checksums(spark, [r["path"] for r in there]).collect()}
    unchanged = {
        r[FILE] for r in there if r["present"] and r["size"] == r["old_size"] and sums.get(r[FILE], "") == r["old_checksum"]
    }
    number = _next_number(spark, tier)
    create_marker(spark, f"{tier}/attempts/{number}")
    ledger = spark.createDataFrame(
        [
            (
                r[FILE],
                r["path"] or r["old_path"],
                r["size"],
                r["modified"],
                sums.get(r[FILE], ""),
                r["path"] is not None,
                r["content"] if r[FILE] in unchanged else number,
                r["days"] if r[FILE] in unchanged else None,
            )
            for r in found
        ],
        LEDGER_SCHEMA[:-1],
    )
    read = [r for r in there if r[FILE] not in unchanged]
    replaced = {day for r in found if r["present"] and r[FILE] not in unchanged for day in r["days"]}
    # Files without lines are noted, but there is nothing in them to read.
    with_lines = [r for r in read if r[FILE] in sums]
    with sized_for(spark, sum(r["size"] for r in with_lines)):
        if with_lines:
            raw = load_readings(
                spark, [r["path"] for r in with_lines], sep, columns=columns, strict=strict, quarantine=True
            )
        else:
            raw = empty_readings(spark)
        write_batch(raw, tier, number, formats=tuple(formats), ledger=ledger, replaced_days=replaced)
    remove(spark, f"{tier}/attempts/{number}")
    return True


def _next_number(spark: SparkSession, tier: str) -> int:
    """Higher than every batch committed or begun."""
    begun = [int(name) for name in names_in(spark, f"{tier}/attempts")]
    return max([committed(spark, tier).last, *begun]) + 1


def follow(
    spark: SparkSession,
    source: str | list[str],
    tier: str,
    sep: str = ";",
    *,
    every: str = "5 minutes",
    after: Callable[[SparkSession], object] | None = None,
    **options: object,
) -> StreamingQuery:
    """Refresh a tier again and again; ``after`` is called when one has changed it.

    A stream of ticks is the clock: its rows are not looked at. A source whose first file is not
    there yet, or is empty, is waited for.
    """

    def tick(ticks: DataFrame, _: int) -> None:
        session = ticks.sparkSession
        try:
            changed = refresh(session, source, tier, sep, **options)
        except ContractError:
            if committed(session, tier).last >= 0:
                raise
            return
        if changed and after is not None:
            after(session)

    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        clock.writeStream.foreachBatch(tick)
        .option("checkpointLocation", f"{tier}/checkpoint")
        .trigger(processingTime=every)
        .start()
    )

