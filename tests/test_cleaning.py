"""Cleaning operators on the reference shapes and on edge cases with known values."""

import datetime as dt
import time

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattline.functions import missing_to_null, number_or_null, reading, wall_clock
from wattline.operators import (
    add_hour_metrics,
    clean_readings,
    daily_peak_hours,
    drop_sentinel_rows,
    hour_of_day_totals,
    rejected_values,
)
from wattline.schema import ContractError

RAW = "ord long, timestamp string, grid_purchase string, grid_feedin string, direct_consumption string"

EDGE_ROWS = [
    (1, "2023-10-01 00:00:00", "100", "10", None),
    (2, "2023-10-01 01:00:00", "999", "999", "Dev test"),
    (3, "2023-10-01 01:00:00", "200.9", "abc", "5"),
    (4, "2023-10-01 01:00:00", "700", "70", "6"),
    (5, "2023-10-01 02:00:00", "200", None, "x"),
    (6, None, "5", "5", "1"),
    (7, "not-a-date", "5", "5", "1"),
    (8, "2023-10-02 00:00:00", "0", "0", "0"),
    (9, "2023-10-02 01:00:00", "0", "0", "-3"),
    (10, "2023-10-03 00:00:00", "-5", "30", "2.7"),
    (11, "2023-10-03 02:00:00", "-7", "30", None),
]

EDGE_EXPECTED = [
    (1, 100, 10, 0, False, 95, 40, False, True),
    (3, 200, 0, 5, True, 200, 0, True, False),
    (5, 200, 0, 0, False, 193, 30, True, False),
    (8, 0, 0, 0, False, 95, 40, True, True),
    (9, 0, 0, -3, False, 200, 0, True, True),
    (10, -5, 30, 2, True, 95, 40, True, True),
    (11, -7, 30, 0, False, 193, 30, False, True),
]

METRIC_COLUMNS = [
    "ord", "grid_purchase", "grid_feedin", "direct_consumption", "direct_consumption_flag",
    "grid_purchase_total", "grid_feedin_total", "max_grid_purchase_hour", "max_grid_feedin_hour",
]


def edge(spark):
    return spark.createDataFrame(EDGE_ROWS, RAW)


def in_order(df, columns):
    return [tuple(r) for r in df.orderBy("ord").select(*columns).collect()]


def test_edge_cases_have_the_known_values(spark):
    result = add_hour_metrics(clean_readings(edge(spark), ["ord"]))
    assert in_order(result, METRIC_COLUMNS) == EDGE_EXPECTED
    assert result.columns == ["timestamp", *METRIC_COLUMNS]


def test_result_does_not_depend_on_partitioning(spark):
    for n in (1, 3, 7):
        shuffled = edge(spark).orderBy(F.desc("ord")).repartition(n)
        assert in_order(add_hour_metrics(clean_readings(shuffled, ["ord"])), METRIC_COLUMNS) == EDGE_EXPECTED


def test_result_does_not_depend_on_the_session_zone(spark):
    rows = [(1, "2024-03-10 02:30:00", "7", "1", "1"), (2, "2024-11-03 01:30:00", "8", "2", "1")]
    seen = set()
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            cleaned = clean_readings(spark.createDataFrame(rows, RAW), ["ord"])
            totals = hour_of_day_totals(cleaned).orderBy("hour")
            text = cleaned.select(F.col("timestamp").cast("string"), "ord").orderBy("ord")
            seen.add(str(totals.collect()) + str(text.collect()))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(seen) == 1 and "hour=2" in seen.pop()


def test_types_and_column_order(spark):
    extra = edge(spark).select("ord", "grid_feedin", F.lit("x").alias("date"),
                               "timestamp", "grid_purchase", "direct_consumption",
                               F.lit("kept").alias("odd.name"))
    cleaned = clean_readings(extra, ["ord"])
    assert cleaned.dtypes == [
        ("timestamp", "timestamp_ntz"), ("ord", "bigint"), ("grid_feedin", "bigint"),
        ("grid_purchase", "bigint"), ("direct_consumption", "bigint"), ("odd.name", "string"),
        ("direct_consumption_flag", "boolean"),
    ]
    enriched = add_hour_metrics(cleaned)
    assert enriched.columns == cleaned.columns + METRIC_COLUMNS[5:]
    assert enriched.select("`odd.name`").distinct().collect()[0][0] == "kept"


def test_source_column_named_hour_is_dropped(spark):
    cleaned = clean_readings(edge(spark).withColumn("hour", F.lit("99")), ["ord"])
    assert in_order(add_hour_metrics(cleaned), METRIC_COLUMNS) == EDGE_EXPECTED
    assert "hour" not in add_hour_metrics(cleaned).columns


def test_columns_that_would_be_overwritten_are_refused(spark):
    cleaned = clean_readings(edge(spark), ["ord"])
    with pytest.raises(ContractError, match="grid_feedin_total"):
        add_hour_metrics(cleaned.withColumn("grid_feedin_total", F.lit(1)))


def test_numeric_columns_may_already_be_typed(spark):
    rows = [(1, dt.datetime(2023, 10, 1), 100, 1.9, 5)]
    typed = spark.createDataFrame(
        rows, "ord long, timestamp timestamp_ntz, grid_purchase int, grid_feedin double, direct_consumption int"
    )
    row = clean_readings(typed, ["ord"]).first()
    assert (row.timestamp, row.grid_purchase, row.grid_feedin, row.direct_consumption_flag) == (
        dt.datetime(2023, 10, 1), 100, 1, True,
    )


def test_missing_columns_are_named(spark):
    with pytest.raises(ContractError, match="grid_feedin, direct_consumption"):
        clean_readings(edge(spark).drop("grid_feedin", "direct_consumption"), ["ord"])
    with pytest.raises(ContractError, match="_read_order"):
        clean_readings(edge(spark))


def test_empty_input_gives_empty_output_with_all_columns(spark):
    result = add_hour_metrics(clean_readings(edge(spark).limit(0), ["ord"]))
    assert result.count() == 0 and result.columns == ["timestamp", *METRIC_COLUMNS]


def test_sentinel_match_is_exact_and_null_safe(spark):
    values = [None, "Dev test", "dev test", " Dev test", "Dev test ", "1"]
    df = spark.createDataFrame([(v,) for v in values], "direct_consumption string")
    kept = [r[0] for r in drop_sentinel_rows(df).collect()]
    assert kept == [None, "dev test", " Dev test", "Dev test ", "1"]


NUMBERS = {
    "5": 5, " 5 ": 5, "\t5": 5, "+7": 7, ".5": 0, "5.": 5, "1e3": 1000, "-5.9": -5, "5.9": 5,
    "1E+2": 100, "abc": None, "": None, "True": None, "1,000": None, "1_000": None, "0x1F": None,
    "NaN": None, "1d": None, "1f": None, "5L": None, "0x1p3": None, "٣": None, "inf": None,
    "Infinity": None, "1e20": None, ".": None, "+": None, "--5": None, "1e400": None,
    "9007199254740993": 9007199254740993, "9223372036854775807": 9223372036854775807,
    "9223372036854775808": None, "9.223372036854775808e18": None, "-9.3e18": None, "\x005": None,
    "-9223372036854775808": -9223372036854775808,
}


def test_numeric_text(spark):
    df = spark.createDataFrame([(k,) for k in NUMBERS], "s string")
    got = {r.s: (r.n, r.z) for r in df.select("s", number_or_null(F.col("s")).alias("n"), reading(F.col("s")).alias("z")).collect()}
    assert got == {k: (v, v or 0) for k, v in NUMBERS.items()}


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.decimals(-10**9, 10**9, places=3).map(str) | st.integers(-10**15, 10**15).map(str)
                | st.text("0123456789.eE+- x", max_size=6), min_size=200, max_size=300))
def test_numbers_agree_with_an_independent_parser(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(reading(F.col("s"))).collect()]
    for text, value in zip(texts, got):
        number = pd.to_numeric(pd.Series([text], dtype=object), errors="coerce").fillna(0).iloc[0]
        # Beyond the range of 64 bits the two differ on purpose.
        if abs(number) < 2**63:
            assert value == int(number), text


def test_rejected_values_are_counted(spark):
    counts = {r.column_name: r.rejected_count for r in rejected_values(edge(spark)).collect()}
    assert counts == {"grid_purchase": 0, "grid_feedin": 1, "direct_consumption": 2}


TIMES = {
    "2023-10-01 00:00:00": "2023-10-01 00:00:00",
    "2023-10-01 00:00": "2023-10-01 00:00:00",
    "2023-10-01": "2023-10-01 00:00:00",
    "2023-10-01 00:00:00.25": "2023-10-01 00:00:00.25",
    "2023-10-01T05:00:00Z": "2023-10-01 05:00:00",
    "2023-10-01 05:00:00+02:00": "2023-10-01 05:00:00",
    "garbage": None, "": None, "2023-02-30": None, "2023-10-01 24:00:00": None,
    "now": None, "13/02/2023": None, "20231001": None, "10:00": None,
    "1600-01-01": None, "2300-01-01": None, "+294247-01-01": None,
    "1700-01-01": "1700-01-01 00:00:00", "2262-04-11 23:47:16": "2262-04-11 23:47:16",
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamp_text(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(k,) for k in TIMES], "s string")
        got = {r.s: r.t for r in df.select("s", wall_clock(F.col("s")).cast("string").alias("t")).collect()}
        assert got == TIMES
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_timestamp_formats_are_opt_in_and_tried_in_order(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        texts = ["01/02/2023 03:00", "13/02/2023 02:30", "20231001", "2023-10-01 07:00", "31/02/2023 00:00", "1/2/2023 03:00"]
        df = spark.createDataFrame([(t,) for t in texts], "s string")
        parsed = wall_clock(F.col("s"), ["dd/MM/yyyy HH:mm", "yyyyMMdd"]).cast("string")
        assert [r[0] for r in df.select(parsed).collect()] == [
            "2023-02-01 03:00:00", "2023-02-13 02:30:00", "2023-10-01 00:00:00",
            "2023-10-01 07:00:00", None, None,
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    with pytest.raises(ValueError, match="yyyy"):
        wall_clock(F.col("s"), ["dd/MM"])


def test_missing_tokens_match_exactly(spark):
    texts = ["NA", "n/a", "null", "NULL", "nan", "#N/A", "", " NA", "na", "None", "0"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert [r[0] for r in df.select(missing_to_null(F.col("s"))).collect()] == [None] * 7 + [" NA", "na", "None", "0"]


def test_hourly_peaks_per_day_keep_ties(spark):
    cleaned = clean_readings(edge(spark), ["ord"])
    got = {(str(r.day), r.measure, r.hour, r.total) for r in daily_peak_hours(cleaned).collect()}
    assert got == {
        ("2023-10-01", "grid_purchase", 1, 200), ("2023-10-01", "grid_purchase", 2, 200),
        ("2023-10-01", "grid_feedin", 0, 10),
        ("2023-10-02", "grid_purchase", 0, 0), ("2023-10-02", "grid_purchase", 1, 0),
        ("2023-10-02", "grid_feedin", 0, 0), ("2023-10-02", "grid_feedin", 1, 0),
        ("2023-10-03", "grid_purchase", 0, -5),
        ("2023-10-03", "grid_feedin", 0, 30), ("2023-10-03", "grid_feedin", 2, 30),
    }


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 400), st.integers(-50, 50), st.integers(-50, 50)), min_size=1, max_size=80))
def test_properties_of_any_table(spark, rows):
    start = dt.datetime(2024, 2, 28)
    raw = spark.createDataFrame(
        [(i, str(start + dt.timedelta(minutes=13 * m)), str(p), str(f), None) for i, (m, p, f) in enumerate(rows)], RAW
    )
    cleaned = clean_readings(raw, ["ord"])
    enriched = add_hour_metrics(cleaned).collect()
    first = {}
    for i, (m, p, f) in enumerate(rows):
        first.setdefault(start + dt.timedelta(minutes=13 * m), (i, p, f))
    assert {r.timestamp: (r.ord, r.grid_purchase, r.grid_feedin) for r in enriched} == first
    assert len(enriched) == len(first)
    for column, flag, at in (("grid_purchase", "max_grid_purchase_hour", 1), ("grid_feedin", "max_grid_feedin_hour", 2)):
        for r in enriched:
            day = [v[at] for t, v in first.items() if t.date() == r.timestamp.date()]
            hour = [v[at] for t, v in first.items() if t.hour == r.timestamp.hour]
            assert r[flag] == (r[column] == max(day))
            assert r[column + "_total"] == sum(hour)


def test_very_long_digits_cost_no_more_than_reading_them(spark):
    long = "1" * 100_000 + "x"
    df = spark.createDataFrame([(long,), ("12",), ("1" * 100_000,)], "v string")
    started = time.perf_counter()
    values = [r.n for r in df.select(number_or_null(F.col("v")).alias("n")).collect()]
    assert values == [None, 12, None]
    assert time.perf_counter() - started < 5
