"""The first and last rows of a set of files, from no more files than hold them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattline.operators.explore import first_rows, last_rows
from wattline.sources.delimited import empty_readings, load_readings
from wattline.sources.files import files_at


def first_of_files(spark: SparkSession, path: str | list[str], n: int = 10, sep: str = ";") -> DataFrame:
    """The first rows in file order; files after those that have so many rows are not opened."""
    return first_rows(_enough(spark, path, n, sep, from_end=False), n)


def last_of_files(spark: SparkSession, path: str | list[str], n: int = 10, sep: str = ";") -> DataFrame:
    """The last rows, shown in file order; only the last files are opened."""
    return last_rows(_enough(spark, path, n, sep, from_end=True), n)


def _enough(spark: SparkSession, path: str | list[str], n: int, sep: str, from_end: bool) -> DataFrame:
    """The rows of the first or last files, twice as many until there are n rows; a file is taken whole.

    Whether there are enough is asked for with a limit, so a split is left after n rows.
    """
    names = [r["path"] for r in files_at(spark, path).where("size > 0").orderBy("file").collect()]
    if not names:
        return empty_readings(spark)
    taken = 1
    while True:
        some = names[-taken:] if from_end else names[:taken]
        rows = load_readings(spark, some, sep)
        if taken >= len(names) or rows.limit(n).count() >= n:
            return rows
        taken *= 2
