"""Streaming forms: three arrivals equal one batch run, replays change nothing."""

import datetime as dt

import pytest
from conftest import DATA
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.operators import add_hour_metrics, clean_readings, hourly_rollup
from wattline.schema import CLEAN_SCHEMA, DAY
from wattline.sources import events_as_readings, stream_readings
from wattline.streaming import tier as tier_module
from wattline.streaming import (
    closed_daily_maxima,
    compact,
    first_within_watermark,
    ingest,
    read_clean,
    read_commits,
    read_enriched,
    read_quarantined,
    read_rollup,
    running_hour_totals,
    typed_rows,
    write_batch,
)

WITH_ID = T.StructType([*CLEAN_SCHEMA.fields, T.StructField("event_id", T.LongType())])


def rows_of(df):
    columns = sorted(df.columns)
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def arrivals(spark):
    raw = events_as_readings(spark, DATA)
    return [raw.where(F.floor(F.col("event_id") / 334) == i) for i in range(3)]


def test_three_arrivals_equal_one_batch_run(spark, tmp_path):
    feed, tier = str(tmp_path / "feed"), str(tmp_path / "tier")
    raw = events_as_readings(spark, DATA)
    for part in arrivals(spark):
        part.write.mode("append").parquet(feed)
        stream = spark.readStream.schema(raw.schema).parquet(feed)
        ingest(stream, tier, order_by=["event_id"], every=None).awaitTermination()
    cleaned = clean_readings(raw, ["event_id"])
    assert rows_of(read_clean(spark, tier, WITH_ID)) == rows_of(cleaned)
    assert rows_of(read_enriched(spark, tier, WITH_ID)) == rows_of(add_hour_metrics(cleaned))


def test_replayed_batch_changes_nothing(spark, tmp_path):
    tier = str(tmp_path / "tier")
    parts = arrivals(spark)
    for number, part in enumerate(parts):
        write_batch(part, tier, number, ["event_id"])
    before = rows_of(read_enriched(spark, tier, WITH_ID))
    write_batch(parts[2], tier, 2, ["event_id"])
    assert rows_of(read_enriched(spark, tier, WITH_ID)) == before
    cleaned = clean_readings(events_as_readings(spark, DATA), ["event_id"])
    assert before == rows_of(add_hour_metrics(cleaned))


def test_batch_without_usable_rows_and_empty_tier(spark, tmp_path):
    tier = str(tmp_path / "tier")
    assert read_enriched(spark, tier).count() == 0
    raw = events_as_readings(spark, DATA)
    write_batch(raw.withColumn("timestamp", F.lit("never")), tier, 0, ["event_id"])
    assert read_clean(spark, tier).count() == 0


@pytest.mark.parametrize("days", [5, 500])
def test_few_and_many_days_take_the_same_path(spark, tmp_path, days):
    tier = str(tmp_path / "tier")
    raw = spark.range(days).select(
        F.col("id").alias("event_id"),
        F.concat(F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int")).cast("string"), F.lit(" 05:00:00")).alias("timestamp"),
        F.col("id").cast("string").alias("grid_purchase"),
        F.lit("1").alias("grid_feedin"),
        F.lit(None).cast("string").alias("direct_consumption"),
    )
    write_batch(raw.where(F.col("event_id") < days - 3), tier, 0, ["event_id"])
    write_batch(raw, tier, 1, ["event_id"])
    cleaned = clean_readings(raw, ["event_id"])
    assert rows_of(read_clean(spark, tier, WITH_ID)) == rows_of(cleaned)
    assert rows_of(read_rollup(spark, tier)) == rows_of(hourly_rollup(cleaned))
    # The second batch has stored its own three days and no others.
    parts = [p for p in (tmp_path / "tier" / "rollup").glob("*/batch_id=1")]
    assert len(parts) == 3


def test_an_unfinished_batch_is_not_seen(spark, tmp_path, monkeypatch):
    tier = str(tmp_path / "tier")
    parts = arrivals(spark)
    write_batch(parts[0], tier, 0, ["event_id"])
    before = rows_of(read_enriched(spark, tier, WITH_ID))

    def fail(*_):
        raise RuntimeError("lost between the writes")

    with monkeypatch.context() as patch:
        patch.setattr("wattline.streaming.tier._met_hours", fail)
        with pytest.raises(RuntimeError, match="between the writes"):
            write_batch(parts[1], tier, 1, ["event_id"])
    assert list((tmp_path / "tier" / "clean").glob("*/batch_id=1"))
    assert rows_of(read_enriched(spark, tier, WITH_ID)) == before
    write_batch(parts[1], tier, 1, ["event_id"])
    write_batch(parts[2], tier, 2, ["event_id"])
    cleaned = clean_readings(events_as_readings(spark, DATA), ["event_id"])
    assert rows_of(read_enriched(spark, tier, WITH_ID)) == rows_of(add_hour_metrics(cleaned))


def test_a_batch_that_meets_nothing_reads_no_earlier_rows(spark, tmp_path, monkeypatch):
    """Rows of the same hours, but of other seconds: the bitmaps tell, and row files are not looked at."""
    tier = str(tmp_path / "tier")
    rows = readings(spark, [(i, f"2024-01-05 10:{i:02d}:00") for i in range(20)])
    others = readings(spark, [(100 + i, f"2024-01-05 10:{i:02d}:30") for i in range(20)])
    same = readings(spark, [(50, "2024-01-05 10:07:00"), (51, "2024-01-05 10:08:00.5")])
    write_batch(rows, tier, 0, ["event_id"])
    read: list[str] = []
    look = tier_module._read_days
    monkeypatch.setattr(tier_module, "_read_days", lambda s, path, *a: read.append(path) or look(s, path, *a))
    write_batch(others, tier, 1, ["event_id"])
    assert read == [f"{tier}/rollup"]
    write_batch(same, tier, 2, ["event_id"])
    assert f"{tier}/clean" in read
    raw = rows.unionByName(others).unionByName(same)
    assert rows_of(read_clean(spark, tier, WITH_ID)) == rows_of(clean_readings(raw, ["event_id"]))


def test_rows_that_may_meet_are_compared_by_place_and_timestamp(spark, tmp_path):
    tier = str(tmp_path / "tier")
    write_batch(arrivals(spark)[0], tier, 0, ["event_id"])
    rows = tier_module._read_days(spark, f"{tier}/clean", [dt.date(2024, 1, 5)], tier_module._stored_schema(spark, tier, WITH_ID))
    text = rows.select("timestamp", "_place")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<timestamp:timestamp_ntz,_place:struct<event_id:bigint>>" in text
    assert "PartitionFilters" in text


def readings(spark, rows):
    columns = ["event_id", "timestamp"]
    return spark.createDataFrame(rows, columns).select(
        *columns,
        F.col("event_id").cast("string").alias("grid_purchase"),
        F.lit("1").alias("grid_feedin"),
        F.lit(None).cast("string").alias("direct_consumption"),
    )


def test_fractions_of_a_second(spark, tmp_path):
    tier = str(tmp_path / "tier")
    batches = [
        [(5, "2024-01-05 10:00:00.25"), (6, "2024-01-05 10:00:00.5"), (7, "2024-01-05 10:00:00")],
        [(1, "2024-01-05 10:00:00.25"), (9, "2024-01-05 10:00:00.5"), (8, "2024-01-05 10:00:00.75")],
        [(2, "2024-01-05 10:00:00"), (0, "2024-01-05 10:00:00.25")],
    ]
    for number, rows in enumerate(batches):
        write_batch(readings(spark, rows), tier, number, ["event_id"])
    raw = readings(spark, [row for rows in batches for row in rows])
    cleaned = clean_readings(raw, ["event_id"])
    assert rows_of(read_enriched(spark, tier, WITH_ID)) == rows_of(add_hour_metrics(cleaned))


@pytest.mark.parametrize("order", [(2, 1, 0), (1, 2, 0), (0, 2, 1), (2, 0, 1)])
def test_the_first_row_counts_whatever_the_arrival(spark, tmp_path, order):
    """By place, not by arrival; also after compactions at any point."""
    tier = str(tmp_path / "tier")
    parts = arrivals(spark)
    for number, part in enumerate(order):
        write_batch(parts[part], tier, number, ["event_id"])
        if number == order[0] % 2:
            compact(spark, tier, WITH_ID)
    cleaned = clean_readings(events_as_readings(spark, DATA), ["event_id"])
    assert rows_of(read_enriched(spark, tier, WITH_ID)) == rows_of(add_hour_metrics(cleaned))
    compact(spark, tier, WITH_ID)
    assert rows_of(read_enriched(spark, tier, WITH_ID)) == rows_of(add_hour_metrics(cleaned))
    assert not list((tmp_path / "tier" / "hidden").glob("*/batch_id=[0-9]*"))


def test_compaction_changes_no_result_and_leaves_one_part_a_day(spark, tmp_path):
    tier = str(tmp_path / "tier")
    parts = arrivals(spark)
    for number in (0, 1):
        write_batch(parts[number], tier, number, ["event_id"])
    before = rows_of(read_enriched(spark, tier, WITH_ID))
    compact(spark, tier, WITH_ID)
    assert rows_of(read_enriched(spark, tier, WITH_ID)) == before
    assert {p.name for p in (tmp_path / "tier" / "clean").glob("*/*")} == {"batch_id=-2"}
    write_batch(parts[2], tier, 2, ["event_id"])
    compact(spark, tier, WITH_ID)
    cleaned = clean_readings(events_as_readings(spark, DATA), ["event_id"])
    assert rows_of(read_enriched(spark, tier, WITH_ID)) == rows_of(add_hour_metrics(cleaned))
    assert {p.name for p in (tmp_path / "tier" / "rollup").glob("*/*")} == {"batch_id=-3"}
    compact(spark, tier, WITH_ID)


def test_malformed_lines_of_a_stream_are_set_aside_and_counted(spark, tmp_path):
    folder, tier = tmp_path / "in", str(tmp_path / "tier")
    folder.mkdir()
    header = "timestamp;grid_purchase;grid_feedin;direct_consumption"
    (folder / "a.csv").write_text(
        f"{header}\n2023-10-01 00:00:00;1;1;1\n2023-10-01 01:00:00;1;1;1;more\nnever;1;1;1\n"
    )
    stream = stream_readings(spark, str(folder), header.split(";"), quarantine=True)
    ingest(stream, tier, every=None).awaitTermination()
    assert read_clean(spark, tier).count() == 1
    assert [r.line for r in read_quarantined(spark, tier).collect()] == ["2023-10-01 01:00:00;1;1;1;more"]
    (commit,) = read_commits(spark, tier).collect()
    assert (commit.accepted_count, commit.quarantined_count, commit.without_timestamp_count) == (1, 1, 1)


def test_large_day_is_read_by_its_own_folder_only(spark, tmp_path):
    tier = str(tmp_path / "tier")
    raw = events_as_readings(spark, DATA)
    write_batch(raw, tier, 0, ["event_id"])
    table = spark.read.parquet(f"{tier}/clean").where(F.col(DAY) == dt.date(2024, 1, 5))
    plan = table._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(reading_day" in plan


def test_delimited_files_as_a_stream(spark, tmp_path):
    folder, tier = tmp_path / "in", str(tmp_path / "tier")
    folder.mkdir()
    header = "timestamp;grid_purchase;grid_feedin;direct_consumption;date\n"
    (folder / "a.csv").write_text(
        header
        + "2023-10-01 00:00:00;100;10;50;2023-10-01\n"
        + "2023-10-01 01:00:00;9;9;Dev test;2023-10-01\n"
        + "2023-10-01 00:00:00;7;7;7;2023-10-01\n"
    )
    columns = header.strip().split(";")
    for _ in range(2):
        stream = stream_readings(spark, str(folder), columns)
        ingest(stream, tier, every=None).awaitTermination()
        (folder / "b.csv").write_text(
            header + "2023-10-01 00:00:00;1;1;1;x\n" + "2023-10-01 01:00:00;200;20;;x\n"
        )
    got = read_clean(spark, tier).orderBy("timestamp").collect()
    assert [tuple(r)[1:] for r in got] == [(100, 10, 50, True), (200, 20, 0, False)]


def feed_stream(spark, feed):
    raw = events_as_readings(spark, DATA)
    return typed_rows(spark.readStream.schema(raw.schema).parquet(feed))


def test_running_hour_totals(spark, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    for part in arrivals(spark):
        part.write.mode("append").parquet(feed)
        (
            running_hour_totals(feed_stream(spark, feed))
            .writeStream.outputMode("complete")
            .foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out))
            .option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    expected = running_hour_totals(typed_rows(events_as_readings(spark, DATA)))
    assert rows_of(spark.read.parquet(out)) == rows_of(expected)


def test_closed_days_keep_the_first_row_per_timestamp(utc, tmp_path):
    spark, feed, out = utc, str(tmp_path / "feed"), str(tmp_path / "out")
    raw = events_as_readings(spark, DATA)
    for part in arrivals(spark):
        part.write.mode("append").parquet(feed)
        unique = first_within_watermark(feed_stream(spark, feed), "10 minutes", ["event_id"])
        (
            closed_daily_maxima(unique)
            .writeStream.outputMode("append")
            .format("parquet")
            .option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True)
            .start(out)
            .awaitTermination()
        )
    cleaned = clean_readings(raw, ["event_id"])
    closed = (
        cleaned.groupBy(F.to_date("timestamp").alias("day"))
        .agg(F.max("grid_purchase").alias("max_grid_purchase"), F.max("grid_feedin").alias("max_grid_feedin"))
        .where("day < date'2024-01-30'")
    )
    assert rows_of(spark.read.parquet(out)) == rows_of(closed)
    assert closed.count() == 29


def test_streams_refuse_a_zone_with_clock_changes(spark):
    typed = typed_rows(events_as_readings(spark, DATA))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            first_within_watermark(typed, "1 hour", ["event_id"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_day_of_the_rollup_is_one_file(spark, tmp_path):
    """Also where some of its hours are added up anew, and after a compaction."""
    tier = str(tmp_path / "tier")
    days = [dt.date(2020, 1, 1) + dt.timedelta(i) for i in range(6)]
    rows = [(h * 10 + i, f"{day} {h:02d}:00:00") for i, day in enumerate(days) for h in range(1, 20)]
    write_batch(readings(spark, rows[::2]), tier, 0, ["event_id"])
    write_batch(readings(spark, [(n - 5, t) for n, t in rows]), tier, 1, ["event_id"])
    folders = list((tmp_path / "tier" / "rollup").glob("*/batch_id=1"))
    assert [len(list(f.glob("*.parquet"))) for f in folders] == [1] * 6
    before = rows_of(read_rollup(spark, tier))
    compact(spark, tier, WITH_ID)
    folders = list((tmp_path / "tier" / "rollup").glob("*/*"))
    assert [len(list(f.glob("*.parquet"))) for f in folders] == [1] * 6
    assert rows_of(read_rollup(spark, tier)) == before
