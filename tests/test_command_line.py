"""The command line runs the same job and the same stream."""

from wattline.__main__ import main
from wattline.streaming import read_enriched

LINES = "timestamp;grid_purchase;grid_feedin;direct_consumption;date\n01/10/2023 05:00;7;8;9;x\n"


def test_batch_and_follow(spark, tmp_path, capsys):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(LINES)
    formats = ["--timestamp-format", "dd/MM/yyyy HH:mm"]
    main([str(folder), str(tmp_path / "out"), "--single-file", *formats])
    assert "exported_rows=1" in capsys.readouterr().out
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text().splitlines()[1] == "2023-10-01 05:00:00,7,8,9,True,7,8,True,True"
    main([str(folder), str(tmp_path / "tier"), "--follow", "--once", *formats])
    assert read_enriched(spark, str(tmp_path / "tier")).first().grid_feedin_total == 8


def test_follow_reads_a_rewritten_file_again(spark, tmp_path):
    source, tier, out = tmp_path / "a.csv", str(tmp_path / "tier"), tmp_path / "out"
    header = "timestamp;grid_purchase;grid_feedin;direct_consumption\n"
    source.write_text(header + "2023-10-01 05:00:00;7;8;9\n")
    follow = [str(source), tier, "--follow", "--once", "--export", str(out), "--single-file"]
    main(follow)
    source.write_text(header + "2023-10-01 05:00:00;70;8;9\n2023-10-01 06:00:00;1;1;1\n")
    main([*follow, "--compact"])
    (part,) = out.glob("part-*")
    assert len(part.read_text().splitlines()) == 3
    assert [r.grid_purchase for r in read_enriched(spark, tier).orderBy("timestamp").collect()] == [70, 1]
