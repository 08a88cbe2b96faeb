"""Delimited text in: header names, every column as text, file order kept as a column."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from wattline.functions import missing_to_null
from wattline.schema import RAW_SCHEMA, READ_ORDER, ContractError, quoted
from wattline.sources.multiline import multiline_scan

_LINE = "_malformed_line"
_MALFORMED = "_malformed"
#: In a stream that keeps its malformed lines: the line, NULL for good rows.
QUARANTINED = "_quarantined_line"


def text_options(sep: str) -> dict[str, object]:
    """Reader options: a quote inside a quoted field is doubled, blanks are kept."""
    return {"sep": sep, "header": True, "quote": '"', "escape": '"', "encoding": "UTF-8", "maxCharsPerColumn": -1}


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def header_columns(spark: SparkSession, path: str | list[str], sep: str = ";") -> list[str]:
    """Column names from the header line; reads no data beyond it.

    A blank name becomes ``Unnamed: i`` by its place, a repeated one gets ``.1``, ``.2``.
    """
    return _distinct_names(_header(spark, path, sep))


def _header(spark: SparkSession, path: str | list[str], sep: str) -> list[str]:
    """The header as it stands in the file; a file without any line is an error."""
    plain = text_options(sep) | {"header": False, "ignoreLeadingWhiteSpace": False}
    first = spark.read.options(**plain).csv(path).limit(1).collect()
    if not first:
        raise ContractError(f"no header line in {path}")
    return ["" if name is None else name for name in first[0]]


def _distinct_names(header: list[str]) -> list[str]:
    names: list[str] = []
    taken = set(header)
    for i, name in enumerate(header):
        if not name.strip():
            name = f"Unnamed: {i}"
        elif name in names:
            number = 1
            while f"{name}.{number}" in taken | set(names):
                number += 1
            name = f"{name}.{number}"
        names.append(name)
    return names


def read_order(streaming: bool = False) -> Column:
    """Position of a row in its source: file, split, line. Valid directly on a file scan.

    A stream cannot number its lines; ``number_lines`` does so for each of its batches.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        (F.lit(0).cast("bigint") if streaming else F.monotonically_increasing_id()).alias("line"),
    )


def number_lines(batch: DataFrame) -> DataFrame:
    """Complete the order column of a streamed batch, whose partitions are still file splits."""
    numbered = F.col(READ_ORDER).withField("line", F.monotonically_increasing_id())
    return batch.withColumn(READ_ORDER, numbered) if READ_ORDER in batch.columns else batch


def load_readings(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ";",
    *,
    columns: list[str] | None = None,
    missing: str = "error",
    strict: bool = False,
    multiline: bool = False,
    quarantine: bool = False,
    metrics: Observation | None = None,
) -> DataFrame:
    """Load raw readings as text columns plus the internal order column.

    Rows with too few fields are padded with NULL and blank lines are skipped. Rows with too
    many fields, and malformed rows whose quoted field does not end on its line, are left out and
    can be read with ``read_quarantine``; ``strict=True`` fails the job on the first of them
    instead. ``multiline=True`` reads quoted line breaks (see ``multiline``): files are still read in
    splits, and one reading of the text comes before. An absent path raises, or gives an empty table of the contract's columns
    with ``missing="empty"``; so does a file without any line. With ``quarantine`` malformed lines
    stay, marked in the column ``QUARANTINED``. ``metrics`` receives ``row_count``
    and ``quarantined_count`` with the first action, which must be one over all rows. Naming the
    header's ``columns`` saves reading it. All files must have the same header; where a name in
    it is blank or repeated, only the number of columns is the same by contract, not checked.
    """
    if missing not in ("error", "empty"):
        raise ValueError("missing must be 'error' or 'empty'")
    try:
        header = columns or _header(spark, path, sep)
        columns = _distinct_names(header)
        if multiline:
            lines = multiline_scan(spark, path, columns, sep, text_options(sep), _LINE, READ_ORDER)
            lines = lines.withColumn(_MALFORMED, _malformed(columns, sep))
        else:
            lines = _scan(spark.read, path, columns, sep, columns == header)
    except AnalysisException as error:
        if missing == "empty" and is_missing_path(error):
            return empty_readings(spark)
        raise
    except ContractError:
        if missing == "empty":
            return empty_readings(spark)
        raise
    if metrics is not None:
        lines = lines.observe(
            metrics,
            F.count_if(~F.col(_MALFORMED)).alias("row_count"),
            F.count_if(_MALFORMED).alias("quarantined_count"),
        )
    return _accepted(lines, columns, strict, quarantine)


def empty_readings(spark: SparkSession) -> DataFrame:
    """No rows, with the columns of the contract."""
    return spark.createDataFrame([], RAW_SCHEMA).withColumn(READ_ORDER, _no_order())


def stream_readings(
    spark: SparkSession,
    path: str,
    columns: list[str],
    sep: str = ";",
    *,
    strict: bool = False,
    quarantine: bool = False,
    **options: object,
) -> DataFrame:
    """The same table as a stream over a folder that receives new files.

    ``columns`` are the header names (``header_columns`` reads them from a sample); ``options`` go
    to the file source, for example ``maxFilesPerTrigger``. With ``quarantine`` malformed lines
    stay, marked in the column ``QUARANTINED``; ``ingest`` writes them aside and counts them.
    """
    lines = _scan(spark.readStream.options(**options), path, columns, sep)
    return _accepted(lines, columns, strict, quarantine)


def read_quarantine(spark: SparkSession, path: str | list[str], sep: str = ";") -> DataFrame:
    """The lines ``load_readings`` leaves out, with the file each came from."""
    header = _header(spark, path, sep)
    columns = _distinct_names(header)
    lines = _scan(spark.read, path, columns, sep, columns == header).where(_MALFORMED)
    return lines.select(F.col(READ_ORDER)["file"].alias("file"), F.col(_LINE).alias("line"))


def _scan(
    reader, path, columns: list[str], sep: str, check_header: bool = True
) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _LINE]])
    return (
        reader.schema(schema)
        .options(**text_options(sep))
        .options(
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=_LINE,
            # Every file's header must name the same columns in the same order.
            enforceSchema=not check_header,
            # With pruning, a line counts as malformed by the requested columns only.
            columnPruning=False,
        )
        .csv(path)
        .withColumn(READ_ORDER, read_order(isinstance(reader, DataStreamReader)))
        .withColumn(_MALFORMED, _malformed(columns, sep))
    )


def _accepted(
    lines: DataFrame, columns: list[str], strict: bool, quarantine: bool = False
) -> DataFrame:
    keep = ~F.col(_MALFORMED)
    values = [missing_to_null(F.col(quoted(c))).alias(c) for c in columns]
    if quarantine and not strict:
        line = F.when(F.col(_MALFORMED), F.col(_LINE)).alias(QUARANTINED)
        return lines.select(*values, READ_ORDER, line)
    if strict:
        message = F.concat(F.lit("too many fields or an open quote: "), F.col(_LINE))
        keep = F.when(keep, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return lines.where(keep).select(*values, READ_ORDER)


def _malformed(columns: list[str], sep: str) -> Column:
    """A marked line with more separators outside quotes than the header has, or an open quote.

    The reader marks short lines as malformed too, so separators and quotes decide. Only marked
    lines are looked at. Doubled quotes go first, so that a quoted field is a run without quotes,
    which a pattern takes in one step however long it is. Naming a data column next to the line
    is needed because the reader refuses to give the malformed line alone, as when only rows are
    counted.
    """
    line = F.coalesce(F.col(_LINE), F.col(quoted(columns[0])))
    start = f"(^|{re.escape(sep)})"
    unquoted = F.regexp_replace(F.replace(line, F.lit('""'), F.lit("")), f'{start}"[^"]*+"', "$1")
    separators = (F.length(unquoted) - F.length(F.replace(unquoted, F.lit(sep)))) / len(sep)
    open_quote = unquoted.rlike(f'{start}"')
    return F.col(_LINE).isNotNull() & ((separators >= len(columns)) | open_quote)


def _no_order() -> Column:
    return F.lit(None).cast("struct<file:string,block:bigint,line:bigint>")
