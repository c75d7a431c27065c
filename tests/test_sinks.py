"""Sinks of busy keys: files, their order and their tasks."""

import csv

from stopwise.functions.storage import for_small_files
from stopwise.sources import writers


def _files(root):
    return sorted(p for p in root.glob("stop=*/**/*.csv"))


def _events(spark, rows, at):
    return spark.range(rows).selectExpr("id", "if(id % 50 = 0, 'b', 'a') stop_id", "date'2024-02-07' service_date", f"{at} event_time")


def test_busy_keys_in_small_files(spark, tmp_path):
    """a task writes many of a busy key's small files, in order; no file is beyond rows_per_file."""
    writers.write_daily(_events(spark, 6000, "id * 7919 % 6000").repartition(3), str(tmp_path / "out"), rows_per_file=10)
    files = _files(tmp_path / "out")
    tables = [list(csv.DictReader(f.open())) for f in files]
    assert max(map(len, tables)) == 10 and 600 <= len(files) <= 604
    assert len({f.name.split("-")[1] for f in files}) <= 3  # each is a task
    for stop, want in (("a", 5880), ("b", 120)):
        at = [int(r["event_time"]) for f, t in zip(files, tables, strict=True) if f"stop={stop}/" in str(f) for r in t]
        assert len(at) == want and at == sorted(at)
    assert set(tables[0][0]) == {"id", "stop_id", "service_date", "event_time"}
    back = writers.read_placed(for_small_files(spark).read.option("header", True), str(tmp_path / "out"), ["stop", "Year", "Month", "Day"])
    places = sorted((r.stop, int(r.event_time), r.place) for r in back.collect())
    assert [p for s, _, p in places if s == "a"] == [*range(5880)] and [p for s, _, p in places if s == "b"] == [*range(120)]


def test_rows_of_one_place_are_cut(spark, tmp_path):
    """rows that tie in the order fill files of the same size, dealt over tasks."""
    writers.write_daily(_events(spark, 5000, "1"), str(tmp_path / "out"), rows_per_file=10)
    sizes = {f: len(f.read_text().splitlines()) - 1 for f in _files(tmp_path / "out")}
    assert sum(sizes.values()) == 5000 and max(sizes.values()) == 10
    assert len({f.name.split("-")[1] for f in sizes}) > 1 and max(int(f.name.split(".c")[1].split(".")[0]) for f in sizes) < 999


def test_sessions_for_small_files(spark):
    own = for_small_files(spark)
    assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert own.conf.get("spark.sql.files.openCostInBytes") == "65536" != spark.conf.get("spark.sql.files.openCostInBytes")
