"""Delimited files in and out: the shapes of the contract and malformed input."""

import datetime as dt
import gzip

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline import add_hour_metrics, clean_readings, export_readings, load_readings, read_export, read_quarantine, run
from wattline.operators import first_rows, inferred_profile, last_rows, non_missing, table_shape
from wattline.schema import ENRICHED_SCHEMA, READ_ORDER, ContractError
from wattline.sources import export as export_module
from wattline.sources import first_of_files, last_of_files

HEADER = "timestamp;grid_purchase;grid_feedin;direct_consumption;date"
BASIC = [
    "2023-10-01 00:00:00;100;10;50;2023-10-01",
    "2023-10-01 01:00:00;200;20;60;2023-10-01",
    "2023-10-01 02:00:00;300;30;70;2023-10-01",
]


def write(path, lines, header=HEADER):
    path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture
def basic(tmp_path):
    return write(tmp_path / "basic.csv", BASIC)


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_load_gives_all_rows_and_columns_as_text(spark, basic):
    raw = load_readings(spark, basic)
    assert raw.count() == 3
    assert raw.drop(READ_ORDER).dtypes == [(c, "string") for c in HEADER.split(";")]
    assert table_shape(raw).first() == (3, 5)


def test_load_metrics_come_with_the_first_action(spark, tmp_path):
    seen = Observation()
    path = write(tmp_path / "a.csv", [*BASIC, "2023-10-01 03:00:00;1;1;1;x;too;many"])
    assert load_readings(spark, path, metrics=seen).count() == 3
    assert seen.get == {"row_count": 3, "quarantined_count": 1}


def test_absent_file(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        load_readings(spark, str(tmp_path / "none.csv"))
    empty = load_readings(spark, str(tmp_path / "none.csv"), missing="empty")
    assert empty.count() == 0
    assert add_hour_metrics(clean_readings(empty)).columns == ENRICHED_SCHEMA.names


def test_header_only_file(spark, tmp_path):
    raw = load_readings(spark, write(tmp_path / "h.csv", []))
    assert raw.count() == 0 and add_hour_metrics(clean_readings(raw)).count() == 0


def test_malformed_lines(spark, tmp_path):
    lines = [
        "2023-10-01 00:00:00;1;1;1;x",
        "2023-10-01 01:00:00;2",
        "",
        "2023-10-01 02:00:00;3;3;3;x;extra",
        "2023-10-01 03:00:00;4;4;4;x;",
        '2023-10-01 04:00:00;5;5;5;"a;b ""c"""',
        '"2023-10-01 05:00:00";6;6;"6;7;8"',
    ]
    path = write(tmp_path / "m.csv", lines)
    rows = values(load_readings(spark, path).orderBy(READ_ORDER), "grid_purchase", "direct_consumption", "date")
    assert rows == [("1", "1", "x"), ("2", None, None), ("5", "5", 'a;b "c"'), ("6", "6;7;8", None)]
    assert [r.line for r in read_quarantine(spark, path).collect()] == [lines[3], lines[4]]
    assert read_quarantine(spark, path).first().file.endswith("m.csv")
    with pytest.raises(Exception, match="too many fields"):
        load_readings(spark, path, strict=True).count()
    strict = load_readings(spark, write(tmp_path / "ok.csv", lines[:2]), strict=True)
    assert strict.count() == 2


def test_long_and_open_quotes(spark, tmp_path):
    long = '"' + "x" * 1_000_000 + ';""y"""'
    lines = [
        f"2023-10-01 00:00:00;1;1;1;{long}",
        f"{long};2",
        f"2023-10-01 02:00:00;3;3;3;{long};extra",
        '"2023-10-01 03:00:00;4;4;4;x',
    ]
    path = write(tmp_path / "q.csv", lines)
    assert values(load_readings(spark, path).orderBy(READ_ORDER), "grid_purchase") == [("1",), ("2",)]
    assert [r.line for r in read_quarantine(spark, path).collect()] == lines[2:]
    with pytest.raises(Exception, match="open quote"):
        load_readings(spark, write(tmp_path / "o.csv", lines[3:]), strict=True).count()


def test_quoted_line_breaks(spark, tmp_path):
    path = write(tmp_path / "n.csv", ['"2023-10-01 00:00:00";1;2;3;"a', 'b"', "2023-10-01 01:00:00;4;5;6;x"])
    raw = load_readings(spark, path, multiline=True)
    assert values(raw.orderBy(READ_ORDER), "grid_purchase", "date") == [("1", "a\nb"), ("4", "x")]


def test_blank_and_repeated_header_names(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        write(tmp_path / name, [f"{name};2023-10-01 0{len(name)}:00:00;1;2;3;p;q"], f";{HEADER[:-5]};x;x")
    raw = load_readings(spark, str(tmp_path))
    assert raw.columns == ["Unnamed: 0", *HEADER.split(";")[:-1], "x", "x.1", READ_ORDER]
    assert values(raw.orderBy(READ_ORDER), "`Unnamed: 0`", "`x.1`") == [("a.csv", "q"), ("b.csv", "q")]
    assert clean_readings(raw).count() == 1


def test_a_file_without_any_line(spark, tmp_path):
    (tmp_path / "z.csv").write_text("")
    with pytest.raises(ContractError, match="no header"):
        load_readings(spark, str(tmp_path / "z.csv"))
    assert load_readings(spark, str(tmp_path / "z.csv"), missing="empty").count() == 0


def test_absent_source_through_the_whole_job(spark, tmp_path):
    target = tmp_path / "out"
    report = run(spark, str(tmp_path / "none.csv"), str(target), missing="empty")
    assert (report.loaded_rows, report.quarantined_rows, report.exported_rows) == (0, 0, 0)
    assert not target.exists()


def test_a_failing_export_leaves_the_last_result(spark, tmp_path):
    target = str(tmp_path / "out")
    good = spark.sql("SELECT timestamp_ntz'2023-01-01' AS timestamp, 1 AS x")
    assert export_readings(good, target)
    bad = good.select("timestamp", F.raise_error(F.lit("broken")).cast("int").alias("x"))
    with pytest.raises(Exception, match="broken"):
        export_readings(bad, target)
    assert not export_readings(good.where("x > 1"), target)
    assert read_export(spark, target, schema=good.schema).count() == 1
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    export_readings(good, target, mode="append")
    assert read_export(spark, target, schema=good.schema).count() == 2
    assert not export_readings(good, target, mode="ignore")


def test_a_loaded_table_is_exported_with_true_counts(spark, tmp_path):
    path = write(tmp_path / "big.csv", [f"2023-10-01 00:00:00;{i};0;0;x" for i in range(400_000)])
    for kind in ("parquet", "csv"):
        seen = Observation()
        raw = load_readings(spark, path, metrics=seen)
        assert export_readings(raw, str(tmp_path / kind), format=kind, ordered=False)
        assert seen.get["row_count"] == 400_000
    assert READ_ORDER not in spark.read.parquet(str(tmp_path / "parquet")).columns


def test_rows_without_a_timestamp_are_counted(spark, tmp_path):
    path = write(tmp_path / "t.csv", [*BASIC, "never;1;1;1;x", ";1;1;1;x", "1600-01-01;1;1;1;x"])
    report = run(spark, path, str(tmp_path / "out"))
    assert (report.loaded_rows, report.without_timestamp_rows, report.exported_rows) == (6, 3, 3)


def test_missing_tokens_become_null(spark, tmp_path):
    raw = load_readings(spark, write(tmp_path / "t.csv", ["2023-10-01;NA;n/a;null;", "2023-10-01 01:00; NA;0;Dev test;x"]))
    assert values(raw.orderBy(READ_ORDER), "grid_purchase", "grid_feedin", "direct_consumption", "date") == [
        (None, None, None, None), (" NA", "0", "Dev test", "x"),
    ]
    assert non_missing(raw, "direct_consumption").count() == 1


def test_other_delimiters(spark, tmp_path):
    for sep, name in ((",", "comma"), ("|", "pipe"), ("\t", "tab"), ("||", "pair")):
        lines = [*[x.replace(";", sep) for x in BASIC], sep.join("abcdef")]
        path = write(tmp_path / f"{name}.csv", lines, HEADER.replace(";", sep))
        assert load_readings(spark, path, sep).count() == 3, name
        assert read_quarantine(spark, path, sep).count() == 1, name


def test_headers_must_agree_between_files(spark, tmp_path):
    write(tmp_path / "a.csv", BASIC)
    write(tmp_path / "b.csv", BASIC, "timestamp;grid_feedin;grid_purchase;direct_consumption;date")
    with pytest.raises(Exception, match="(?i)header"):
        load_readings(spark, str(tmp_path)).collect()


def test_first_row_wins_across_splits_and_files(spark, tmp_path):
    # Large enough for several splits; every timestamp occurs once per file and once per half.
    n = 3000
    start = dt.datetime(2023, 1, 1)
    for name, base in (("b.csv", 20000), ("a.csv", 0)):
        write(tmp_path / name, [
            f"{start + dt.timedelta(minutes=i % n)};{base + i};0;0;x" for i in range(2 * n)
        ])
    spark.conf.set("spark.sql.files.maxPartitionBytes", 16384)
    try:
        raw = load_readings(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() > 8
        got = {r.timestamp: r.grid_purchase for r in clean_readings(raw).collect()}
        assert got == {start + dt.timedelta(minutes=i): i for i in range(n)}
        head = [r.grid_purchase for r in first_rows(raw).collect()]
        tail = [r.grid_purchase for r in last_rows(raw).collect()]
        assert head == [str(i) for i in range(10)]
        assert tail == [str(20000 + i) for i in range(2 * n - 10, 2 * n)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_compressed_file(spark, tmp_path):
    with gzip.open(tmp_path / "z.csv.gz", "wt") as f:
        f.write("\n".join([HEADER, *BASIC]))
    assert load_readings(spark, str(tmp_path / "z.csv.gz")).count() == 3


def test_whole_job(spark, basic, tmp_path):
    target = str(tmp_path / "out")
    report = run(spark, basic, target)
    assert (report.loaded_rows, report.loaded_columns, report.quarantined_rows) == (3, 5, 0)
    assert (report.exported_rows, report.exported_columns) == (3, 9)
    rows = values(read_export(spark, target).orderBy("timestamp"), "*")
    assert [r[1:] for r in rows] == [
        (100, 10, 50, True, 100, 10, False, False),
        (200, 20, 60, True, 200, 20, False, False),
        (300, 30, 70, True, 300, 30, True, True),
    ]


def test_written_text(spark, tmp_path):
    path = write(tmp_path / "x.csv", ["2023-10-01 00:00:00;1.9;;-1;d", "2023-10-01 01:00:00.5;2;3;4;d"])
    target = tmp_path / "out"
    run(spark, path, str(target), single_file=True, target_sep="|")
    (part,) = target.glob("part-*.csv")
    assert part.read_text() == (
        "timestamp|grid_purchase|grid_feedin|direct_consumption|direct_consumption_flag|grid_purchase_total"
        "|grid_feedin_total|max_grid_purchase_hour|max_grid_feedin_hour\n"
        "2023-10-01 00:00:00|1|0|-1|False|1|0|False|False\n"
        "2023-10-01 01:00:00.5|2|3|4|True|2|3|True|True\n"
    )


def test_text_with_blanks_and_quotes_survives(spark, tmp_path):
    rows = [(dt.datetime(2023, 1, 1), ' a, "b" '), (dt.datetime(2023, 1, 2), None)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, note string")
    assert export_readings(df, str(tmp_path / "o"))
    assert values(read_export(spark, str(tmp_path / "o"), schema=df.schema).orderBy("timestamp"), "*") == rows


def test_nothing_is_written_for_an_empty_table(spark, tmp_path):
    target = tmp_path / "out"
    report = run(spark, write(tmp_path / "h.csv", []), str(target))
    assert report.exported_rows == 0 and not target.exists()
    schema = T.StructType([T.StructField("timestamp", T.TimestampNTZType())])
    assert not export_readings(spark.createDataFrame([], schema), str(target))
    assert not target.exists()


def test_export_is_in_time_order_over_part_files(spark, tmp_path):
    target = tmp_path / "out"
    df = spark.range(5000).select(
        (F.lit(dt.datetime(2023, 1, 1)) + F.make_dt_interval(mins=(F.col("id") * 7919 % 5000).cast("int"))).alias("timestamp")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export_readings(df.repartition(8), str(target))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted(target.glob("part-*.csv"))
    lines = [line for p in parts for line in p.read_text().splitlines()[1:]]
    assert len(parts) > 1 and lines == sorted(lines) and len(lines) == 5000


def test_parquet_sink_and_modes(spark, basic, tmp_path):
    target = str(tmp_path / "pq")
    run(spark, basic, target, format="parquet", ordered=False)
    assert spark.read.parquet(target).dtypes == [(f.name, f.dataType.simpleString()) for f in ENRICHED_SCHEMA]
    with pytest.raises(FileExistsError):
        run(spark, basic, target, format="parquet", mode="errorifexists")
    with pytest.raises(ValueError):
        run(spark, basic, target, format="xml")


def exported(spark, path):
    return sorted(r.grid_purchase for r in read_export(spark, path).collect())


def some_enriched(spark, values):
    rows = [(f"2024-01-01 00:{i:02d}:00", str(v), "1", "1") for i, v in enumerate(values)]
    raw = spark.createDataFrame(rows, "timestamp string, grid_purchase string, grid_feedin string, direct_consumption string")
    return add_hour_metrics(clean_readings(raw, ["timestamp"]))


def test_snapshots_leave_no_moment_without_a_result(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "out")
    assert export_readings(some_enriched(spark, [1, 2]), target, snapshots=2)
    reader = read_export(spark, target)
    seen = []
    publish = export_module.add_snapshot

    def look(*arguments):
        seen.append(exported(spark, target))
        publish(*arguments)
        seen.append(exported(spark, target))

    monkeypatch.setattr(export_module, "add_snapshot", look)
    assert export_readings(some_enriched(spark, [3]), target, snapshots=2)
    assert seen == [[1, 2], [3]]
    # A reader that began before still has its files.
    assert sorted(r.grid_purchase for r in reader.collect()) == [1, 2]
    assert export_readings(some_enriched(spark, [4]), target, snapshots=2)
    assert len(list((tmp_path / "out").glob("snapshot-*"))) == 2 and exported(spark, target) == [4]


def test_a_failed_or_empty_snapshot_changes_nothing(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "out")
    export_readings(some_enriched(spark, [1]), target, snapshots=1)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(export_module, "add_snapshot", fail)
        with pytest.raises(OSError, match="lost"):
            export_readings(some_enriched(spark, [2]), target, snapshots=1)
    assert not export_readings(some_enriched(spark, [3]).limit(0), target, snapshots=1)
    assert exported(spark, target) == [1]
    assert len(list((tmp_path / "out").glob("snapshot-*"))) == 1
    plain = str(tmp_path / "plain")
    export_readings(some_enriched(spark, [1]), plain)
    with pytest.raises(FileExistsError, match="without snapshots"):
        export_readings(some_enriched(spark, [2]), plain, snapshots=1)
    with pytest.raises(ValueError, match="whole"):
        export_readings(some_enriched(spark, [2]), target, snapshots=1, mode="append")


def test_first_and_last_rows_open_few_files(spark, tmp_path):
    for i in range(20):
        write(tmp_path / f"{i:02d}.csv", [f"2023-10-01 00:00:{j:02d};{100 * i + j};1;1;x" for j in range(3)])
    head, tail = first_of_files(spark, str(tmp_path), 7), last_of_files(spark, str(tmp_path), 7)
    assert [r.grid_purchase for r in head.collect()] == ["0", "1", "2", "100", "101", "102", "200"]
    assert [r.grid_purchase for r in tail.collect()] == ["1702", "1800", "1801", "1802", "1900", "1901", "1902"]
    assert len(head.inputFiles()) == 4 and len(tail.inputFiles()) == 4
    assert first_of_files(spark, str(tmp_path), 1000).count() == 60
    (tmp_path / "none").mkdir()
    assert last_of_files(spark, str(tmp_path / "none")).count() == 0


def test_inferred_types(spark):
    columns = {
        "whole": ["1", " -2 ", None], "mixed": ["1", "2.5", "1e3"], "truth": ["True", "false", None],
        "day": ["2024-01-05", None, "2023-12-31"], "stamp": ["2024-01-05", "2024-01-05 10:00:00", None],
        "text": ["1", "2024-01-05", "x"], "none": [None, None, None], "large": ["9223372036854775808", "1", "2"],
        "no_day": ["2024-02-30", None, None],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} string" for c in columns))
    got = {r.column_name: (r.data_type, r.row_count, r.non_null_count) for r in inferred_profile(df).collect()}
    kinds = ["bigint", "double", "boolean", "date", "timestamp", "string", "void", "double", "string"]
    assert got == {c: (k, 3, sum(v is not None for v in columns[c])) for c, k in zip(columns, kinds)}
