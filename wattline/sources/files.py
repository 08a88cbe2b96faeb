"""Folders on any file system Spark reads: sizes, listings, and publishing by a rename."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _path(spark, path)
    return system.exists(at)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names directly in a folder; none if there is no such folder."""
    system, at = _path(spark, path)
    return [status.getPath().getName() for status in system.listStatus(at)] if system.exists(at) else []


def total_bytes(spark: SparkSession, paths: str | list[str]) -> int:
    """Bytes of all files that paths, folders or patterns name; 0 if they name none."""
    size = 0
    for path in [paths] if isinstance(paths, str) else paths:
        system, at = _path(spark, path)
        for status in system.globStatus(at) or []:
            size += system.getContentSummary(status.getPath()).getLength()
    return size


def matches(spark: SparkSession, paths: str | list[str]) -> bool:
    """Whether there is a file or folder for every one of the paths or patterns."""
    found = []
    for path in [paths] if isinstance(paths, str) else paths:
        system, at = _path(spark, path)
        found.append(len(system.globStatus(at) or []) > 0)
    return all(found)


def remove(spark: SparkSession, path: str) -> None:
    system, at = _path(spark, path)
    system.delete(at, True)


SNAPSHOTS = "_snapshots"


def add_snapshot(spark: SparkSession, path: str, name: str) -> None:
    """Makes a finished folder ``name`` in ``path`` the current one, by the name of an empty file.

    Names begin with a number that goes up; a file is there or not, so readers see the snapshot before
    or this one, on an object store as well, and nothing is moved.
    """
    last = max((n.partition("-")[0] for n in names_in(spark, f"{path}/{SNAPSHOTS}")), default="0")
    create_marker(spark, f"{path}/{SNAPSHOTS}/{int(last) + 1:012d}-{name}")


def current_snapshot(spark: SparkSession, path: str) -> str | None:
    """The folder that readers of ``path`` should read; None if it has no snapshots."""
    names = sorted(names_in(spark, f"{path}/{SNAPSHOTS}"))
    return f"{path}/{names[-1].partition('-')[2]}" if names else None


def drop_snapshots(spark: SparkSession, path: str, keep: int) -> None:
    """Removes all snapshots but the last ``keep``, which readers may still be reading."""
    for name in sorted(names_in(spark, f"{path}/{SNAPSHOTS}"))[:-keep]:
        remove(spark, f"{path}/{name.partition('-')[2]}")
        remove(spark, f"{path}/{SNAPSHOTS}/{name}")


def files_at(spark: SparkSession, source: str | list[str]) -> DataFrame:
    """The files that a path, folder or pattern names: file (as rows have it), path, size, modified."""
    found = spark.read.format("binaryFile").load(source)
    return found.select(
        F.col("_metadata.file_path").alias("file"),
        "path",
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def create_marker(spark: SparkSession, path: str) -> None:
    """An empty file, which also object stores show."""
    system, at = _path(spark, path)
    system.create(at, True).close()


def beside(path: str, purpose: str) -> str:
    """A new name in the folder of ``path``, hidden from Spark's readers."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_{name}-{purpose}-{uuid.uuid4().hex}" if folder else f"_{name}-{purpose}-{uuid.uuid4().hex}"


def add_files(spark: SparkSession, staged: str, target: str) -> None:
    """Moves the data files of a finished folder into ``target``, and removes the folder."""
    system, _ = _path(spark, target)
    for name in names_in(spark, staged):
        if not name.startswith(("_", ".")):
            system.rename(_path(spark, f"{staged}/{name}")[1], _path(spark, f"{target}/{name}")[1])
    remove(spark, staged)


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Puts a finished folder in the place of ``target``; what was there goes only then.

    On a file system with renames readers see the old result or the new one, and for a moment
    none; an object store copies, and its readers should take the success marker as the sign.
    """
    old = beside(target, "old")
    system, at = _path(spark, target)
    _, new = _path(spark, staged)
    _, aside = _path(spark, old)
    had = system.exists(at)
    if had and not system.rename(at, aside):
        raise OSError(f"cannot move {target} aside")
    if not system.rename(new, at):
        if had:
            system.rename(aside, at)
        raise OSError(f"cannot publish {target}")
    if had:
        system.delete(aside, True)
