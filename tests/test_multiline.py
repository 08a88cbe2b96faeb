"""Quoted line breaks against Python's csv module, with files cut into many splits."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from wattline.schema import READ_ORDER
from wattline.sources import load_readings, multiline
from wattline.sources.multiline import broken_records, text_lines

HEADER = ["timestamp", "grid_purchase", "grid_feedin", "direct_consumption", "note"]


@pytest.fixture(params=[None, 37, 200])
def split(spark, request):
    """Splits of so many bytes; None leaves files whole."""
    if request.param is None:
        yield None
        return
    keys = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": 1}
    before = {key: spark.conf.get(key) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, str(value))
    yield request.param
    for key, value in before.items():
        spark.conf.set(key, value)


def write(path, rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, delimiter=";", lineterminator=end).writerows([HEADER, *rows])
    path.parent.mkdir(exist_ok=True)
    path.write_bytes(out.getvalue().encode())


def read(spark, path):
    rows = load_readings(spark, str(path), multiline=True)
    return [tuple(r)[:-1] for r in rows.orderBy(READ_ORDER).collect()]


def some_rows(rng, n):
    pieces = ["a", "b;c", 'say ""', '"', "\n", "\n\n", ";", "é", "x" * 50, '";"', '"\n"', "\n;\n"]
    rows = []
    for i in range(n):
        note = "n" + "".join(rng.choice(pieces) for _ in range(rng.randrange(6))) + "e"
        first = f"2024-01-01 00:00:{i % 60:02d}" if rng.random() < 0.8 else "2024-01-01\n00:00:00"
        rows.append((first, str(i), "1", "2", note))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_records_are_those_of_the_csv_module(spark, tmp_path, split, seed):
    rng = random.Random(seed)
    wanted = []
    for name in "abc":
        rows = some_rows(rng, 40)
        write(tmp_path / f"{name}.csv", rows)
        wanted += rows
    assert read(spark, tmp_path) == wanted


def test_a_record_over_many_splits(spark, tmp_path, split):
    rows = [("t1", "1", "1", "1", "\n".join(f"line {i}" for i in range(100))), ("t2", "2", "2", "2", "x")] * 3
    write(tmp_path / "a.csv", rows)
    assert read(spark, tmp_path) == rows
    if split:
        assert load_readings(spark, str(tmp_path), multiline=True).rdd.getNumPartitions() > 1
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10


def test_quotes_that_are_no_quotes_and_open_ends(spark, tmp_path, split):
    """A quote inside a field means nothing; a field that nothing closes ends with its line."""
    (tmp_path / "a.csv").write_text(
        ";".join(HEADER) + '\nt1;1;1;1;5" pipe\n\nt2;2;2;2;"a ""b""\nc"\nt3;3;3;3;6" pipe\nt4;4;4;4;"open\nt5;5;5;5;x\n'
    )
    assert read(spark, tmp_path) == [
        ("t1", "1", "1", "1", '5" pipe'), ("t2", "2", "2", "2", 'a "b"\nc'), ("t3", "3", "3", "3", '6" pipe'),
        ("t4", "4", "4", "4", "open"), ("t5", "5", "5", "5", "x"),
    ]


def test_line_ends_of_two_characters(spark, tmp_path, split):
    rows = [("t1", "1", "1", "1", "a b"), ("t2", "2", "2", "2", "c\nd")]
    write(tmp_path / "a.csv", rows, "\r\n")
    assert read(spark, tmp_path) == rows


def test_files_without_such_records_and_empty_ones(spark, tmp_path):
    write(tmp_path / "a.csv", [("t1", "1", "1", "1", "x")])
    (tmp_path / "b.csv").write_text("")
    write(tmp_path / "c.csv", [])
    assert read(spark, tmp_path) == [("t1", "1", "1", "1", "x")]
    members, _ = broken_records(text_lines(spark, str(tmp_path)), ";", str(tmp_path / "work"))
    assert members.count() == 0


def test_only_lines_of_such_records_are_joined(spark, tmp_path):
    rows = [("t", str(i), "1", "1", "two\nlines" if i % 100 == 0 else '"quoted"') for i in range(1000)]
    write(tmp_path / "a.csv", rows)
    members, _ = broken_records(text_lines(spark, str(tmp_path / "a.csv")), ";", str(tmp_path / "work"))
    assert members.count() == 20
    assert members.groupBy("record").agg(F.count("*").alias("n")).where("n != 2").count() == 0


def test_files_with_other_headers_are_refused(spark, tmp_path):
    write(tmp_path / "a.csv", [("t1", "1", "1", "1", "x")])
    (tmp_path / "b.csv").write_text("a;b\n1;2\n")
    with pytest.raises(ValueError, match="different headers"):
        load_readings(spark, str(tmp_path), multiline=True)


def test_lines_that_change_the_state_are_dealt_by_split(spark, tmp_path, monkeypatch):
    """However small their table is on disk, no task takes those of all files."""
    for i in range(12):
        write(tmp_path / f"in/{i}.csv", [("t", str(i), "1", "1", "two\nlines")] * 20)
    written = {}

    def keep(rows, purpose, folder):
        written[purpose] = rows
        return materialize(rows, purpose, folder)

    materialize = multiline.materialize
    monkeypatch.setattr(multiline, "materialize", keep)
    broken_records(text_lines(spark, str(tmp_path / "in")), ";", str(tmp_path / "work"))
    for purpose in ("ends", "members"):
        places = written[purpose].groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert len(places) > 3
        assert max(p["count"] for p in places) < sum(p["count"] for p in places) / 2
