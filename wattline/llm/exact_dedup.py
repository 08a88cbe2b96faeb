"""Exact deduplication with a stream whose keyed state lives on disk."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm.common import materialize
from wattline.session import work_folder

_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # An open store holds some 4 MB of local disk, however little is in it.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in _STATE}
    for key, value in _STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    for space in " \t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def located(docs: DataFrame) -> DataFrame:
    """Digest, size, identifier and content locator of each row; ``docs`` reads files."""
    return docs.select(
        F.sha2(normalised(F.col("text")), 256).alias("text_sha256"),
        F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_points"),
        "doc_id",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )


def best_of(rows: DataFrame, *keys: str) -> DataFrame:
    """Group size and the row that stays: most code points, then smallest doc_id, then place.

    ``max`` over a struct combines before the shuffle, so a group of any size arrives as one row
    from each task. A null doc_id comes last.
    """
    best = F.max(F.struct("n_points", (-F.col("doc_id")).alias("minus_id"), "file", "row"))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))


def digest_state(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, checkpoint: str | None = None
) -> DataFrame:
    """Streams the files below ``path`` into keyed state; gives the last state of each digest.

    The state has a row for each digest: how many rows had it, and length, identifier and content
    locator of the row that stays. It never expires and lives in RocksDB, saved to the shared
    folder after every batch. Changed groups go to a folder per batch, which a repeated batch
    replaces. With the same ``checkpoint`` a later call reads new files only.
    """
    base = checkpoint or work_folder(spark, "exact")
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", files_per_trigger)
    # As a pattern, a path may be a folder or a single file; a plain one must be a folder here.
    pattern = f"{path[:-1]}[{path[-1]}]"
    groups = best_of(located(stream.parquet(pattern)), "text_sha256")

    def keep(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{base}/groups/batch={batch}")

    with _state_on_disk(spark):
        (
            groups.writeStream.outputMode("update")
            .foreachBatch(keep)
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    # Without any input file no batch ran.
    schema = T.StructType([*groups.schema.fields, T.StructField("batch", T.LongType())])
    spark.createDataFrame([], groups.schema).write.mode("append").parquet(f"{base}/groups/batch=-1")
    changes = spark.read.schema(schema).parquet(f"{base}/groups")
    last = F.max(F.struct("group_size", "best")).alias("last")
    return changes.groupBy("text_sha256").agg(last).select("text_sha256", "last.*")


def exact_duplicates(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, checkpoint: str | None = None
) -> DataFrame:
    """One row per row of the Parquet table at ``path``, kept or not.

    Columns: doc_id, keep_id, group_size, kept, text_sha256. Texts are equal when the same
    without ASCII white space. Where the stream reports a digest more than once, the full bytes
    of each such row are read at its locator and compared with those of the row that stays; rows
    whose bytes differ under one digest are grouped by their whole text instead.

    A null text is an empty one. Of repeated rows with equal ids one stays. A null doc_id is a
    row like any other and stays only if no row with an id is as long. An empty table gives no
    rows. Other columns of the table play no part.
    """
    groups = materialize(digest_state(spark, path, files_per_trigger, checkpoint), "digests")
    table = spark.read.parquet(path)
    rows = materialize(located(table), "rows")

    hits = groups.where("group_size > 1").select("text_sha256", "best")
    contents = table.select(
        F.sha2(normalised(F.col("text")), 256).alias("text_sha256"),
        normalised(F.col("text")).alias("content"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    texts = contents.join(hits, "text_sha256")
    texts = materialize(texts, "hits")
    stays = (F.col("file") == F.col("best.file")) & (F.col("row") == F.col("best.row"))
    keepers = texts.where(stays).select("text_sha256", F.col("content").alias("kept_content"))
    differ = (
        texts.where(~stays)
        .join(keepers, "text_sha256")
        .where("content <> kept_content")
        .select("text_sha256")
    )
    # Written before the distinct: a join on its own can be split where one digest has most rows.
    differ = materialize(materialize(differ, "unequal").distinct(), "collisions")

    same_digest = rows.join(groups, "text_sha256").join(differ, "text_sha256", "left_anti")
    found = texts.join(differ, "text_sha256", "left_semi").select("file", "row", "content")
    collided = rows.join(found, ["file", "row"])
    by_content = best_of(collided, "text_sha256", "content")
    regrouped = collided.join(by_content, ["text_sha256", "content"]).drop("content")
    return same_digest.unionByName(regrouped.select(same_digest.columns)).select(
        "doc_id",
        (-F.col("best.minus_id")).alias("keep_id"),
        "group_size",
        stays.alias("kept"),
        "text_sha256",
    )


#: The same as SQL.
EXACT_SQL = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents),
placed AS (
  SELECT doc_id, content, count(*) OVER (PARTITION BY content) AS group_size,
         first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place
  FROM rows WINDOW w AS (PARTITION BY content ORDER BY n_points DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(content) AS text_sha256 FROM placed
"""
