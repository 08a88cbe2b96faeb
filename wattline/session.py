"""Session settings the jobs are tuned for, and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


_MB = 1024**2


def settings_for(input_bytes: int) -> dict[str, str]:
    """Split and shuffle sizes for an input of a known size.

    The driver keeps an entry per pair of map task and shuffle partition, so both numbers
    are held down by larger pieces as the input grows: 100 TB gives 100,000 splits of 1 GB
    and 50,000 partitions. Larger splits also drop more duplicates before the shuffle. AQE
    merges partitions that turn out small.
    """
    split = min(1024 * _MB, max(128 * _MB, input_bytes // 100_000))
    partitions = min(50_000, max(200, input_bytes // (256 * _MB)))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
    }


def build_session(
    app_name: str = "wattline", input_bytes: int | None = None, **settings: str
) -> SparkSession:
    """A session with the recommended settings; the master comes from the launcher."""
    builder = SparkSession.builder.appName(app_name)
    sizes = settings_for(input_bytes) if input_bytes else {}
    for key, value in {**SETTINGS, **sizes, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def stateful_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings under which to start a stateful stream; a started stream keeps them.

    The zone is UTC, as watermarks need. ``partitions`` is the number of parts the state is cut
    into, for the whole life of the stream: some 1 GB of state in each is a good size, and every
    one commits a store per batch. Without it the session's shuffle partitions hold, which
    ``build_session`` takes from the size of the input; the cores there happen to be at the start
    say nothing about a stream that runs for months.
    """
    wanted = {"spark.sql.session.timeZone": "UTC"}
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@contextmanager
def sized_for(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Split and shuffle sizes for one job; settings the session was given stay as they are."""
    wanted = {
        key: value
        for key, value in settings_for(input_bytes).items()
        if key not in given_settings(spark)
    }
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def given_settings(spark: SparkSession) -> set[str]:
    """The settings that were named when the session was built."""
    return {key for key, _ in spark.sparkContext.getConf().getAll()}


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the folder that driver and executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Without it only a local
    session gets a folder of its own, since a machine-local one is not seen by executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise RuntimeError("set spark.checkpoint.dir to a folder all machines share")
        base = os.path.join(tempfile.gettempdir(), "wattline")
    return f"{base.rstrip('/')}/wattline-{uuid.uuid4().hex}/{purpose}"


def materialize(df: DataFrame, purpose: str, work: str | None = None) -> DataFrame:
    """Write a table to the shared work folder and read it back.

    The result is columnar, so later steps read only the columns they need, and it does not
    depend on the executors that made it. Every call takes a new folder, below ``work`` if given.
    """
    path = f"{work}/{purpose}" if work else work_folder(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
