"""The shape of physical plans: shuffles, partial steps before them, pruning, no Python."""

import contextlib
import io
import re

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from wattline import add_hour_metrics, clean_readings, load_readings
from wattline.operators import daily_peak_hours, first_rows, hourly_rollup, last_rows
from wattline.plans import materialize
from wattline.plans.catalog import QUERIES
from wattline.sources import events_as_readings
from wattline.streaming import first_within_watermark, read_clean, typed_rows, write_batch


def plan(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def shuffles(text):
    return re.findall(r"(?<!Broadcast)Exchange (\w+\([^)]*\)|SinglePartition)", text)


@pytest.fixture(scope="module")
def cleaned(spark):
    return materialize(clean_readings(events_as_readings(spark, DATA), ["event_id"]), "cleaned")


def test_cleaning_shuffles_once_after_reducing_duplicates_in_each_task(spark):
    text = plan(clean_readings(events_as_readings(spark, DATA), ["event_id"]))
    (only,) = shuffles(text)
    assert only.startswith("hashpartitioning(timestamp")
    above, below = text.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in below and "row_number(), 1, Partial" in below
    assert "row_number(), 1, Final" in above


def test_cleaning_of_files_has_the_same_shape(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("timestamp;grid_purchase;grid_feedin;direct_consumption\n2023-10-01;1;2;3\n")
    text = plan(clean_readings(load_readings(spark, str(path))))
    assert len(shuffles(text)) == 1 and "1, Partial" in text


def test_enrichment_never_shuffles_rows(cleaned):
    rollup = materialize(hourly_rollup(cleaned), "rollup")
    text = plan(add_hour_metrics(cleaned, rollup))
    assert sorted(s.split("#")[0] for s in shuffles(text)) == [
        "hashpartitioning(hour", "hashpartitioning(reading_day",
    ]
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    # Rows come first in the plan; between them and the result there are only the two joins.
    rows = text[: text.index("FileScan")]
    assert "Exchange" not in rows and "Window" not in rows


def test_the_public_call_cleans_once(spark):
    """Behind it stand a table and its rollup: one scan and one row-level shuffle of raw rows."""
    raw = spark.range(1000).select(
        F.col("id").alias("ord"), F.lit("2024-01-15 12:00:00").alias("timestamp"),
        F.lit("1").alias("grid_purchase"), F.lit("2").alias("grid_feedin"), F.lit("3").alias("direct_consumption"),
    )
    enriched = add_hour_metrics(clean_readings(raw, ["ord"]))
    text = plan(enriched)
    assert "Range" not in text and "Window" not in text
    assert text.count("FileScan") == 3
    assert not [s for s in shuffles(text) if "timestamp" in s]


def test_rollup_reads_three_columns_and_aggregates_before_its_shuffle(cleaned):
    text = plan(hourly_rollup(cleaned))
    assert "ReadSchema: struct<timestamp:timestamp_ntz,grid_purchase:bigint,grid_feedin:bigint>" in text
    assert len(shuffles(text)) == 1
    assert text.index("partial_sum") > text.index("Exchange")


def test_emptiness_check_of_an_enriched_table_needs_no_join(cleaned):
    text = plan(add_hour_metrics(cleaned).select().limit(1))
    assert "Join" not in text and "Aggregate" not in text


def test_peak_hours_rank_a_small_table(cleaned):
    text = plan(daily_peak_hours(cleaned))
    scan_side = text[text.rindex("Exchange"):]
    assert "partial_sum" in scan_side and "Window" not in scan_side


def test_first_and_last_rows_are_a_top_n(spark):
    raw = events_as_readings(spark, DATA)
    for df in (first_rows(raw, 10, ["event_id"]), last_rows(raw, 10, ["event_id"])):
        text = plan(df)
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_stream_deduplication_reduces_before_its_shuffle(utc):
    typed = typed_rows(events_as_readings(utc, DATA))
    text = plan(first_within_watermark(typed, "1 hour", ["event_id"]))
    (only,) = shuffles(text)
    assert only.startswith("hashpartitioning(timestamp")
    assert "partial_min_by" in text[text.index("Exchange"):]


def test_a_tier_without_hidden_rows_is_read_as_it_lies(spark, tmp_path):
    tier = str(tmp_path / "tier")
    write_batch(events_as_readings(spark, DATA), tier, 0, ["event_id"])
    text = plan(read_clean(spark, tier))
    assert not shuffles(text) and "Join" not in text
    assert "_place" not in text[text.index("ReadSchema"):]


def test_column_pruning_reaches_the_scan(spark):
    text = plan(QUERIES["consumption_flagged"](spark, DATA))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in text


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream")))
def test_no_python_worker_and_no_unbounded_join(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert node not in text


def test_a_timestamp_with_a_third_of_all_rows_reaches_the_shuffle_once_per_task(spark):
    n, tasks = 30_000, 6
    raw = spark.range(0, n, 1, tasks).select(
        F.col("id").alias("ord"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-15 12:00:00"))
        .otherwise((F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).cast("string"))
        .alias("timestamp"),
        F.lit("1").alias("grid_purchase"), F.lit("2").alias("grid_feedin"), F.lit("3").alias("direct_consumption"),
    )
    cleaned = clean_readings(raw, ["ord"])
    assert cleaned.count() == n - n // 3 + 1
    written = shuffle_records(cleaned)
    assert written <= n - n // 3 + tasks
    assert cleaned.where("timestamp = timestamp_ntz'2024-01-15 12:00:00'").first().ord == 0


def shuffle_records(df):
    """Rows the only exchange of a plan wrote, from the metrics of the executed plan."""
    df.collect()
    found = []

    def visit(node):
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            visit(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            visit(node.plan())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(df._jdf.queryExecution().executedPlan())
    (records,) = found
    return records
