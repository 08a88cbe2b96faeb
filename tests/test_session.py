"""Settings by input size, and where intermediate tables go."""

import pytest

from wattline.operators import clean_readings
from wattline.plans import materialize, run
from wattline.session import settings_for, stateful_settings, work_folder
from wattline.sources import load_readings
from wattline.sources.files import total_bytes

HEADER = "timestamp;grid_purchase;grid_feedin;direct_consumption\n"


def sizes(input_bytes):
    return tuple(int(v) for v in settings_for(input_bytes).values())


def test_split_and_shuffle_sizes_stay_bounded():
    mb = 1024**2
    assert sizes(10**6) == (128 * mb, 200)
    split, partitions = sizes(100 * 10**12)
    assert split == 10**9 and partitions == 50_000
    assert sizes(10**15) == (1024 * mb, 50_000)


def test_work_folders_are_new_and_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first != second and first.startswith(base) and first.endswith("/x")


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_folder(Session(), "x")


def test_recurring_runs_leave_no_tables_behind(spark, tmp_path):
    source, work, target = tmp_path / "a.csv", tmp_path / "work", str(tmp_path / "out")
    for n in (3, 2):
        source.write_text(HEADER + "".join(f"2023-10-01 0{i}:00:00;{i};0;0\n" for i in range(n)))
        assert run(spark, str(source), target, work=str(work)).exported_rows == n
    assert spark.read.csv(target, header=True).count() == 2
    assert list(work.iterdir()) == []


def test_a_run_takes_its_sizes_from_the_listing(spark, tmp_path, monkeypatch):
    source = tmp_path / "a.csv"
    source.write_text(HEADER + "2023-10-01 00:00:00;1;2;3\n")
    monkeypatch.setattr("wattline.plans.job.total_bytes", lambda *_: 10 * 1024**4)
    seen = []
    monkeypatch.setattr(
        "wattline.session.given_settings", lambda _: {"spark.sql.shuffle.partitions"}
    )
    load = load_readings

    def loading(session, *args, **options):
        seen.append(session.conf.get("spark.sql.files.maxPartitionBytes"))
        seen.append(session.conf.get("spark.sql.shuffle.partitions"))
        return load(session, *args, **options)

    monkeypatch.setattr("wattline.plans.job.load_readings", loading)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    run(spark, str(source), str(tmp_path / "out"))
    assert seen == [settings_for(10 * 1024**4)["spark.sql.files.maxPartitionBytes"], "4"]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert total_bytes(spark, str(source)) == source.stat().st_size
    assert total_bytes(spark, str(tmp_path / "none*")) == 0


def test_named_columns_replace_reading_the_header(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(HEADER + "2023-10-01;1;2;3\n")
    columns = HEADER.strip().split(";")
    assert materialize(clean_readings(load_readings(spark, str(path), columns=columns)), "t").count() == 1
    with pytest.raises(Exception, match="(?i)header"):
        load_readings(spark, str(path), columns=columns[::-1]).collect()


def test_stateful_settings_are_put_back(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        with stateful_settings(spark):
            assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
            assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
        with stateful_settings(spark, 16):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "16"
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Kolkata"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
