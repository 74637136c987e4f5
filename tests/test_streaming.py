from lanecast.sources.macros import read_series
from lanecast.streaming.macro_ingest import ingest_available


def _drop(folder, name, rows):
    (folder / name).write_text("series_id,date,value\n" + "\n".join(",".join(r) for r in rows) + "\n")


def test_new_pulls_replace_only_their_series(spark, tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    table, state = str(tmp_path / "series"), str(tmp_path / "state")
    _drop(folder, "a1.csv", [("A", "2020-01-01", "1"), ("A", "2020-02-01", "."), ("B", "2020-01-01", "2")])
    ingest_available(spark, str(folder), table, state).awaitTermination()
    _drop(folder, "a2.csv", [("A", "2020-01-01", "9"), ("A", "2020-03-01", "10")])
    ingest_available(spark, str(folder), table, state).awaitTermination()
    got = sorted((r["series_id"], str(r["date"]), r["value"]) for r in read_series(spark, table).collect())
    assert got == [("A", "2020-01-01", 9.0), ("A", "2020-03-01", 10.0), ("B", "2020-01-01", 2.0)]
    ingest_available(spark, str(folder), table, state).awaitTermination()
    assert read_series(spark, table).count() == 3


def test_newest_of_several_pulls_wins(spark, tmp_path):
    import os

    folder = tmp_path / "drop"
    folder.mkdir()
    _drop(folder, "new.csv", [("A", "2020-01-01", "5")])
    _drop(folder, "old.csv", [("A", "2020-01-01", "1"), ("A", "2020-02-01", "2")])
    os.utime(folder / "old.csv", (1_000_000_000, 1_000_000_000))
    table = str(tmp_path / "series")
    ingest_available(spark, str(folder), table, str(tmp_path / "state")).awaitTermination()
    assert [r["value"] for r in read_series(spark, table).collect()] == [5.0]
