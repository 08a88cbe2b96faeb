"""The events table viewed as raw readings, every column as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.schema import (
    CONSUMPTION,
    FEEDIN,
    MISSING_TOKENS,
    PURCHASE,
    REDUNDANT_DATE,
    SENTINEL,
    TIMESTAMP,
)

EVENT_ID = "event_id"


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def as_readings(events: DataFrame, to_the_minute: bool = True) -> DataFrame:
    """Events as raw readings in the order of ``event_id``.

    Cutting the time to the minute makes duplicate timestamps. The text is taken from the
    timestamp itself, without a detour over a zoned type.
    """
    text = F.col("ts").cast("string")
    if to_the_minute:
        text = F.concat(F.substring(text, 1, 16), F.lit(":00"))
    consumption = (
        F.when(F.col("event_type") == "error", F.lit(SENTINEL))
        .when(F.col("event_type") == "view", F.lit("n/a"))
        .when(F.col("event_type") != "signup", F.col("user_id").cast("string"))
    )
    return events.select(
        F.col(EVENT_ID),
        text.alias(TIMESTAMP),
        F.col("value").cast("string").alias(PURCHASE),
        F.get_json_object("props", "$.k").alias(FEEDIN),
        consumption.alias(CONSUMPTION),
        F.to_date("ts").cast("string").alias(REDUNDANT_DATE),
    )


def events_as_readings(spark: SparkSession, folder: str) -> DataFrame:
    return as_readings(read_events(spark, folder))


# Text put in place of a good value, by the remainder of event_id.
MESSY_TIMES = {3: "not-a-date", 7: "1600-01-01 00:00:00", 11: "", 13: "2024-02-30 00:00:00"}
MESSY_NUMBERS = {
    2: "1d", 4: "0x1F", 6: "1e20", 8: "inf", 10: "9007199254740993", 12: " 12.9 ", 14: "-7.9", 16: "1e3",
}


def messy_readings(spark: SparkSession, folder: str) -> DataFrame:
    """The same readings with unusable, odd and missing text among them.

    By the remainder of event_id: timestamps by 23, where 5 gets a zone offset, purchases by 19,
    and feed-ins by 41, whose first remainders get the missing tokens in order.
    """

    def messy(column: str, by: int, texts: dict[int, str]):
        value = F.col(column)
        for remainder, text in texts.items():
            value = F.when(F.col(EVENT_ID) % by == remainder, F.lit(text)).otherwise(value)
        return value

    offset = F.when(F.col(EVENT_ID) % 23 == 5, F.concat(TIMESTAMP, F.lit("+05:30")))
    return (
        events_as_readings(spark, folder)
        .withColumn(TIMESTAMP, messy(TIMESTAMP, 23, MESSY_TIMES))
        .withColumn(TIMESTAMP, F.coalesce(offset, TIMESTAMP))
        .withColumn(PURCHASE, messy(PURCHASE, 19, MESSY_NUMBERS))
        .withColumn(FEEDIN, messy(FEEDIN, 41, dict(enumerate(MISSING_TOKENS))))
    )


def messy_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The messy readings as lines of text, some too long, short, quoted or with an open quote."""
    raw = messy_readings(spark, folder)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in raw.columns]
    whole = F.concat_ws(";", *fields)
    kind = F.col(EVENT_ID) % 50
    line = (
        F.when(kind == 7, F.concat(whole, F.lit(";one;more")))
        .when(kind == 9, F.concat_ws(";", *fields[:2]))
        .when(kind == 11, F.concat_ws(";", *fields[:5], F.lit('"a;b ""c"""')))
        .when(kind == 13, F.concat(F.lit('"'), whole))
        .otherwise(whole)
    )
    return raw.select(EVENT_ID, line.alias("line"))


def write_messy_files(spark: SparkSession, folder: str, path: str, rows_per_file: int = 100_000) -> str:
    """The messy lines as files with a header each; gives the pattern that names them all."""
    header = ";".join(events_as_readings(spark, folder).columns)
    return _write_lines(messy_lines(spark, folder), header, path, rows_per_file)


NOTE = "note"


def write_noted_files(spark: SparkSession, folder: str, path: str, rows_per_file: int = 100_000) -> str:
    """The readings with a note, which for every seventh row is quoted and holds line breaks, quotes and delimiters."""
    raw = events_as_readings(spark, folder).drop(REDUNDANT_DATE)
    number = F.col(EVENT_ID).cast("string")
    long = F.concat(F.lit('"first;line\nsecond ""quoted""\n\nlast of '), number, F.lit('"'))
    note = F.when(F.col(EVENT_ID) % 7 == 0, long).when(F.col(EVENT_ID) % 11 == 0, '""')
    raw = raw.withColumn(NOTE, note.otherwise(F.concat(F.lit("plain "), number)))
    line = F.concat_ws(";", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in raw.columns])
    return _write_lines(raw.select(EVENT_ID, line.alias("line")), ";".join(raw.columns), path, rows_per_file)


def _write_lines(lines: DataFrame, header: str, path: str, rows_per_file: int) -> str:
    lines = lines.withColumn("part", F.floor(F.col(EVENT_ID) / rows_per_file).cast("bigint"))
    heads = lines.select(F.lit(-1).cast("bigint").alias(EVENT_ID), F.lit(header).alias("line"), "part")
    (
        lines.unionByName(heads.distinct())
        .repartition("part")
        .sortWithinPartitions("part", EVENT_ID)
        .select("part", F.col("line").alias("value"))
        .write.partitionBy("part")
        .text(path)
    )
    return f"{path}/part=*"
