"""Records with quoted line breaks, from files that are still read in splits.

Whether a line starts inside a quoted field depends on all lines before it. Each line by itself says
what it makes of both cases, and these answers combine: most lines leave things as they are, and
need not be looked at again. The others, some open or close a field and some tell the state outright,
are put in order within their split; a row per split carries the state on to the next one. Lines of
a record that spans several are then joined by their numbers, all others are records as they stand.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.schema import quoted
from wattline.session import materialize, work_folder

_AT = ("file", "block")
#: The driver keeps an entry per pair of map task and shuffle partition.
MOST_TASKS = 10_000


def _opens(line: Column, sep: str) -> Column:
    """Whether a line that starts outside of quotes ends inside a quoted field."""
    start = f"(^|{re.escape(sep)})"
    rest = F.regexp_replace(F.replace(line, F.lit('""'), F.lit("")), f'{start}"[^"]*+"', "$1")
    return rest.rlike(f'{start}"')


def _toggled(state: Column, times: Column) -> Column:
    """The state after so many changes."""
    return state != (times % 2 == 1)


def _state_before(order: list[str], within: list[str], entry: Column | None) -> Column:
    """The state before a line or split, from the last one that told it and the changes since.

    Rows have ``tells`` (the state they leave, null if it depends on the state they find) and
    ``changes`` (how often they change it). Null where nothing told it, unless there is an ``entry``.
    """
    earlier = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    so_far = F.sum("changes").over(upto)
    told = F.when(F.col("tells").isNotNull(), F.struct("tells", so_far.alias("so_far")))
    last = F.last(told, ignorenulls=True).over(earlier)
    before = F.coalesce(F.sum("changes").over(earlier), F.lit(0))
    known = _toggled(last["tells"], before - last["so_far"])
    return known if entry is None else F.coalesce(known, _toggled(entry, before))


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of files with their place: file, block (start of the split), id, value."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )


def _tasks_for(splits: DataFrame) -> int:
    """As many tasks as splits, so that what one sorts is that of few splits, however many there are."""
    return min(max(splits.count(), 1), MOST_TASKS)


def broken_records(lines: DataFrame, sep: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """The lines (id, record) of records of more than one line, and (file, block, first, last) of every split.

    ``record`` is the id of the record's first line. A field that no line of its file closes makes no record: its line stays
    alone. Windows span the lines of one split that change the state, and the splits of a file.
    """
    # What a line that starts inside a quoted field makes of it: as if the quote stood before it.
    out, inside = _opens(F.col("value"), sep), _opens(F.concat(F.lit('"'), "value"), sep)
    told = lines.select(*_AT, "id", out.alias("out"), inside.alias("inside"))
    splits = materialize(lines.groupBy(*_AT).agg(F.min("id").alias("first"), F.max("id").alias("last")), "splits", folder)
    events = told.where(F.col("out") | ~F.col("inside")).select(
        *_AT,
        "id",
        F.when(F.col("out") == F.col("inside"), F.col("out")).alias("tells"),
        (F.col("out") & ~F.col("inside")).cast("bigint").alias("changes"),
        "out",
        "inside",
    )
    events = materialize(events, "events", folder)
    # By splits, not by bytes: Spark would take a table this small on disk to one task, or broadcast it.
    dealt = events.repartition(_tasks_for(splits), *_AT)

    # What each split makes of the state it finds: the same two columns, of its last line.
    upto = Window.partitionBy(*_AT).orderBy("id")
    so_far = F.sum("changes").over(upto)
    each = dealt.withColumn("so_far", so_far)
    last = F.max_by(F.struct("tells", "so_far"), F.when(F.col("tells").isNotNull(), F.col("id")))
    of_split = each.groupBy(*_AT).agg(F.sum("changes").alias("all"), last.alias("last"))
    of_split = of_split.select(
        *_AT,
        _toggled(F.col("last.tells"), F.col("all") - F.col("last.so_far")).alias("tells"),
        F.col("all").alias("changes"),
    )
    entry = F.coalesce(_state_before(["block"], ["file"], F.lit(False)), F.lit(False))
    # A row per split is what a join may send to all tasks; the lines stay where their split is.
    entries = materialize(of_split.select(*_AT, entry.alias("entry")), "entries", folder)

    found = dealt.join(entries.hint("broadcast"), list(_AT)).withColumn("state", _state_before(["id"], list(_AT), F.col("entry")))
    opens = ~F.col("state") & F.col("out")
    closes = F.col("state") & ~F.col("inside")
    found = found.where(opens | closes).select(*_AT, "id", opens.alias("opens"))
    found = materialize(found, "ends", folder)

    # Openings and closings alternate within a file. The end of an opening one is the next in its split,
    # or the first closing one of a later split.
    found = found.repartition(_tasks_for(splits), *_AT)
    following = F.lead("id").over(Window.partitionBy(*_AT).orderBy("id"))
    first_close = found.groupBy(*_AT).agg(F.min(F.when(~F.col("opens"), F.struct("id", "block"))).alias("close"))
    later = Window.partitionBy("file").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    closing = splits.join(first_close, list(_AT), "left").select(
        *_AT, F.first("close", ignorenulls=True).over(later).alias("close")
    )
    records = found.withColumn("here", following).where("opens")
    inner = records.where(F.col("here").isNotNull()).select(F.col("id").alias("record"), "id", F.col("here").alias("end"))
    across = records.where(F.col("here").isNull()).join(closing, list(_AT)).where(F.col("close").isNotNull())
    across = across.select(
        F.col("id").alias("record"), "file", F.col("block").alias("from"), F.col("close.block").alias("to"),
        F.col("close.id").alias("end"),
    )
    # One row for every split that such a record touches.
    parts = across.join(splits, "file").where(F.col("block").between(F.col("from"), F.col("to"))).select(
        "record",
        F.when(F.col("block") == F.col("from"), F.col("record")).otherwise(F.col("first")).alias("id"),
        F.when(F.col("block") == F.col("to"), F.col("end")).otherwise(F.col("last")).alias("end"),
    )
    ranges = inner.unionByName(parts)
    members = ranges.select("record", F.explode(F.sequence("id", "end")).alias("id"))
    return materialize(members, "members", folder), splits


def multiline_scan(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str],
    sep: str,
    options: dict[str, object],
    line_column: str,
    order_column: str,
) -> DataFrame:
    """Records of delimited files in which quoted fields may hold line breaks.

    All columns as text, then ``line_column`` (the record where it is malformed) and ``order_column``.
    Every file's first line must be the same header. Blank lines between records are skipped.
    Finding the ends of records reads the text once, when this is called; tables it needs stay in a
    new folder of the work folder for as long as the result is used.
    """
    folder = work_folder(spark, "multiline")
    lines = text_lines(spark, path)
    members, splits = broken_records(lines, sep, folder)
    # The first line of a file is its header.
    heads = splits.where("block = 0").select(F.col("first").alias("id"), F.lit(-1).cast("bigint").alias("record"))
    marked = lines.join(members.unionByName(heads), "id", "left")
    header = marked.where("record = -1").select(F.rtrim(F.lower("value")).alias("header")).distinct().limit(2).collect()
    if len(header) > 1:
        raise ValueError(f"files of {path} have different headers")
    place = F.struct("file", "block", F.col("id").alias("line"))
    alone = marked.where(F.col("record").isNull()).select(place.alias("place"), "value")
    joined = (
        marked.where("record >= 0")
        .groupBy("record")
        .agg(F.sort_array(F.collect_list(F.struct("id", "file", "block", "value"))).alias("all"))
        .select(
            F.struct(F.col("all")[0]["file"].alias("file"), F.col("all")[0]["block"].alias("block"), F.col("record").alias("line")).alias("place"),
            F.array_join(F.transform("all", lambda one: one["value"]), "\n").alias("value"),
        )
    )
    records = alone.unionByName(joined).withColumn("value", F.regexp_replace("value", "\r$", ""))
    records = records.where(F.trim("value") != "")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, line_column]])
    plain = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items() if k not in ("header", "encoding")}
    plain |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": line_column}
    parsed = records.select("place", F.from_csv("value", F.lit(_ddl(schema)), plain).alias("row"))
    return parsed.select(*(F.col(f"row.{quoted(c)}").alias(c) for c in schema.names), F.col("place").alias(order_column))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
