"""The jobs from files to files."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from stopwise import schemas as S
from stopwise.operators import schedule, shaping
from stopwise.plans import jobs
from stopwise.sources import readers
from stopwise.streaming import refresh

WEEK = "monday,tuesday,wednesday,thursday,friday,saturday,sunday"


@pytest.fixture()
def feeds(tmp_path):
    """Two feeds whose tables have different column orders; the first starts with a byte order mark."""
    for name, header in (("20240201", "trip_id,route_id,service_id,direction_id"), ("20240301", "route_id,direction_id,service_id,trip_id,extra")):
        d = tmp_path / "gtfs" / name
        d.mkdir(parents=True)
        rows = [{"trip_id": f"sched{i}", "route_id": r, "service_id": "weekday", "direction_id": "0", "extra": "x"} for r, i in (("Red", 1), ("Red", 2), ("1", 3), ("Boat-F1", 4))]
        mark = "﻿" if name == "20240201" else ""
        (d / "trips.txt").write_text(mark + header + "\n" + "".join(",".join(r[c] for c in header.split(",")) + "\n" for r in rows), encoding="utf-8")
        stops = [("sched1", "70061", "08:00:00"), ("sched1", "70063", "08:05:00"), ("sched2", "70061", "08:10:00"), ("sched2", "70063", "08:16:00"), ("sched3", "67", "05:08:00"), ("sched4", "Boat-Hingham", "07:30:00")]
        (d / "stop_times.txt").write_text("trip_id,stop_id,arrival_time,departure_time\n" + "".join(f"{t},{s},{a},{a}\n" for t, s, a in stops))
        (d / "calendar.txt").write_text(f"service_id,{WEEK},start_date,end_date\nweekday,1,1,1,1,1,0,0,20240101,20241231\n")
        (d / "calendar_dates.txt").write_text("service_id,date,exception_type\nspecial,20240207,2\n")
    index = tmp_path / "feeds.csv"
    index.write_text("feed_start_date,feed_end_date,archive_url\n20240201,20240228,https://x/20240201.zip\n20240301,20240331,https://x/20240301.zip\n")
    return str(tmp_path / "gtfs"), str(index)


def _daily_file(spark, path, day, late=()):
    midnight = int(dt.datetime(day.year, day.month, day.day, 5, tzinfo=dt.timezone.utc).timestamp())
    base = dict.fromkeys(S.DAILY_INPUT) | {"service_date": int(day.strftime("%Y%m%d")), "route_id": "Red", "direction_id": 0, "vehicle_id": "v", "vehicle_label": "1", "scheduled_headway_trunk": 600}
    rows = [base | {"trip_id": "sched1", "stop_id": "70061", "stop_sequence": 1, "stop_timestamp": midnight + 28810}, base | {"trip_id": "sched1", "stop_id": "70063", "stop_sequence": 2, "move_timestamp": midnight + 28900, "stop_timestamp": midnight + 29100}, *[base | r for r in late]]
    schema = ", ".join(f"{c} {S.DAILY_TYPES[c]}" for c in S.DAILY_INPUT)
    spark.createDataFrame([tuple(r[c] for c in S.DAILY_INPUT) for r in rows], schema).write.mode("overwrite").parquet(path)


def test_daily_job_backfill_and_refresh(spark, tmp_path, feeds):
    root, out = str(tmp_path), str(tmp_path / "out")
    path_of = lambda r, d: f"{r}/{d}.parquet"
    for d in (6, 7):
        _daily_file(spark, path_of(root, f"2024-02-0{d}"), dt.date(2024, 2, d))
    used = refresh.backfill(spark, root, *feeds, out, dt.date(2024, 2, 5), dt.date(2024, 2, 8), path_of)
    assert [u[-18:-8] for u in used] == ["2024-02-06", "2024-02-07"]
    back = spark.read.option("header", True).csv(out)
    got = {(r.Day, str(r.stop), r.event_type): (float(r.scheduled_tt), float(r.scheduled_headway)) for r in back.collect()}
    assert got == {(d, *k): v for d in (6, 7) for k, v in {("70061", "ARR"): (0.0, 600.0), ("70061", "DEP"): (0.0, 600.0), ("70063", "ARR"): (300.0, 600.0)}.items()}
    # a late row of one day: that day is replaced, the other stays
    _daily_file(spark, path_of(root, "2024-02-07"), dt.date(2024, 2, 7), [{"trip_id": "sched2", "stop_id": "70061", "stop_sequence": 1, "stop_timestamp": 1707311000}])
    refresh.backfill(spark, root, *feeds, out, dt.date(2024, 2, 7), dt.date(2024, 2, 7), path_of)
    back = spark.read.option("header", True).csv(out)
    assert {r.Day: r["count"] for r in back.groupBy("Day").count().collect()} == {6: 3, 7: 4}
    assert refresh.backfill(spark, root, *feeds, out, dt.date(2023, 1, 1), dt.date(2023, 1, 2), path_of) == []


def test_daily_counts(spark, tmp_path, feeds):
    late = [{"trip_id": "t9", "stop_id": "70061", "stop_sequence": 5, "move_timestamp": 1707311000}, {"trip_id": None, "stop_id": "70061", "stop_sequence": 6, "stop_timestamp": 1707311000}]
    _daily_file(spark, str(tmp_path / "x.parquet"), dt.date(2024, 2, 7), late)
    records = readers.daily_records(spark, str(tmp_path / "x.parquet"))
    assert dict(records.dtypes)["stop_sequence"] == "smallint"
    seen_trips = shaping.shape_daily(records).select("service_date", "trip_id").distinct()
    stops = jobs.dated_stops(seen_trips, readers.gtfs(spark, feeds[0]), readers.feed_index(spark, feeds[1]))
    counts = {}
    assert jobs.daily_events(records, stops, counts).count() == 4
    row = jobs.count_row(spark, counts).first()
    assert tuple(row[c] for c in jobs.COUNTS) == (4, 0, 1, 1, 1) and row.run_at is not None


def test_refresh_clears_folders_without_rows(spark, tmp_path, feeds):
    root, out = str(tmp_path), str(tmp_path / "out")
    path_of = lambda r, d: f"{r}/{d}.parquet"
    days = [dt.date(2024, 2, 6), dt.date(2024, 2, 7)]
    stray = {"trip_id": "sched2", "stop_id": "a=b/c", "stop_sequence": 1, "stop_timestamp": 1707311000}
    for d in days:
        _daily_file(spark, path_of(root, d.isoformat()), d, [stray])
    refresh.backfill(spark, root, *feeds, out, *days, path_of)
    _daily_file(spark, path_of(root, "2024-02-07"), days[1])
    for _ in range(2):
        refresh.backfill(spark, root, *feeds, out, days[1], days[1], path_of)
    assert sorted(p.parent.name for p in (tmp_path / "out").glob("stop=a*/Year=2024/Month=2/Day=*/*.csv")) == ["Day=6"]
    assert not list((tmp_path / "out").glob("stop=a*/Year=2024/Month=2/Day=7"))
    assert spark.read.parquet(f"{out}/_counts").count() == 3


def test_only_wanted_names_are_asked_for(spark, tmp_path):
    (tmp_path / "foreign" / "deep").mkdir(parents=True)
    for i in range(3000):
        (tmp_path / "foreign" / "deep" / f"f{i}").write_text("x")
    (tmp_path / "2024-02-07").mkdir()
    (tmp_path / "2024-02-08").write_text("x")
    jvm = spark._jvm.org.apache.hadoop.fs.FileSystem
    reads = lambda: sum(s.getReadOps() + s.getLargeReadOps() for s in jvm.getAllStatistics())
    before = reads()
    wanted = [f"{tmp_path}/{d}" for d in ("2024-02-06", "2024-02-07", "2024-02-08", "2024-02-09")]
    assert refresh.existing(spark, wanted) == wanted[1:3]
    assert reads() - before < 20


def test_headers_are_found_by_reading_heads(spark, tmp_path):
    line = ",".join(["value"] * 20) + "\n"
    for name, header in (("a.csv", "﻿one,Two"), ("b.csv", "\n\ntwo,one"), ("c.csv", "two,one")):
        (tmp_path / name).write_text(header + "\n" + line * 200_000, encoding="utf-8")
    (tmp_path / "d.csv.gz").write_bytes(gzip.compress(("Two,three\n" + "".join(f"{i * 7919 % 1000003},{i}\n" for i in range(400_000))).encode()))
    (tmp_path / "empty.csv").write_text("")
    jvm = spark._jvm.org.apache.hadoop.fs.FileSystem
    read = lambda: sum(s.getBytesRead() for s in jvm.getAllStatistics())
    before = read()
    heads = readers.heads(spark, str(tmp_path))
    spent = read() - before
    whole = sum(p.stat().st_size for p in tmp_path.iterdir())
    assert spent < whole / 10, (spent, whole)
    assert sorted(r.header.lstrip("﻿") for r in heads.collect()) == ["Two,three", "one,Two", "two,one", "two,one"]
    rows = readers.csv_by_header(spark, [f"{tmp_path}/{n}" for n in ("a.csv", "b.csv", "c.csv", "d.csv.gz")])
    assert sorted(rows.columns) == ["Two", "one", "source_file", "three"] and rows.count() == 1_000_000
    assert rows.filter("three is not null").agg({"three": "max", "Two": "count"}).first()[1] == 400_000


@pytest.fixture()
def any_split(monkeypatch, spark):
    """A limit takes the first row of the last split that has one, as it may on several machines."""
    frame = type(spark.range(0))
    limit = frame.limit
    last = lambda df: df.withColumn("__id", F.monotonically_increasing_id()).filter(F.col("__id") % (1 << 33) == 0).orderBy(F.desc("__id"))
    monkeypatch.setattr(frame, "limit", lambda df, n: limit(last(df), n).drop("__id") if n == 1 else limit(df, n))


def test_headers_of_bus_files_of_several_splits(spark, tmp_path, any_split):
    """the header is the first line of a file, whatever split a limit takes its row from."""
    for name, header in (("old", "HalfTripId,Stop,Direction,TimepointOrder"), ("new", "direction,time_point_order,half_trip_id,stop_id")):
        line = "1234567,7654321,Inbound,5\n" if name == "old" else "Inbound,5,1234567,7654321\n"
        (tmp_path / f"{name}.csv").write_text(header + "\n" + line * 400_000)
    names = ("half_trip_id", "stop_id", "direction_id", "time_point_order")
    rows = readers.bus_rows(spark, [f"{tmp_path}/old.csv", f"{tmp_path}/new.csv"])
    assert [tuple(r) for r in rows.groupBy(*names).count().collect()] == [("1234567", "7654321", "Inbound", 5, 800_000)]


@pytest.mark.parametrize("kinds", [("boolean", "smallint"), ("smallint", "boolean", "smallint", "boolean"), ("int", "bigint")])
def test_mixed_direction_types(spark, tmp_path, kinds):
    schema = lambda k: ", ".join(f"{c} {k if c == 'direction_id' else S.DAILY_TYPES[c]}" for c in S.DAILY_INPUT)
    for i, k in enumerate(kinds):
        row = [1 if c == "stop_sequence" else (True if k == "boolean" else 1) if c == "direction_id" else None for c in S.DAILY_INPUT]
        spark.createDataFrame([tuple(row)], schema(k)).write.parquet(str(tmp_path / f"in/d={i}"))
    paths = [str(tmp_path / f"in/d={i}") for i in range(len(kinds))]
    for given in (paths, [str(tmp_path / "in")]):  # a path of its own for each, and one that holds all
        assert [(r.direction_id, r.stop_sequence) for r in readers.daily_records(spark, given).collect()] == [(1, 1)] * len(kinds)
    assert len(readers.by_schema(spark, paths, S.DAILY_INPUT)) == len(set(kinds))


def test_tables_of_feeds_are_matched_by_name(spark, feeds):
    trips = readers.gtfs(spark, feeds[0])["trips"].collect()
    assert {(r.feed_id, r.trip_id, r.route_id, r.direction_id) for r in trips} == {(f, f"sched{i}", r, 0) for f in ("20240201", "20240301") for r, i in (("Red", 1), ("Red", 2), ("1", 3), ("Boat-F1", 4))}


def test_subway_job(spark, tmp_path, feeds):
    for name, sequence in (("a.csv", "stop_sequence"), ("b.csv", "sync_stop_sequence")):
        (tmp_path / name).write_text(f"service_date,extra,route_id,trip_id,direction_id,stop_id,{sequence},vehicle_id,vehicle_label,event_type,event_time_sec\n2024-02-07,z,Red,t1,0,70061,1,R-001,1801,DEP,28800\n2024-02-08,z,Red,t1,0,70061,1,R-001,1801,DEP,28800\n")
        out = str(tmp_path / f"out-{name}")
        jobs.run_subway(spark, [str(tmp_path / name)], name == "b.csv", *feeds, out, "2024-02-07", "2024-02-07")
        rows = spark.read.option("header", True).csv(out).collect()
        assert [(str(r.stop), r.Year, r.Month, r.stop_sequence, r.scheduled_trip_id, r.scheduled_tt) for r in rows] == [("70061", 2024, 2, "1", "sched1", "0")]
        assert list((tmp_path / f"out-{name}").glob("stop=70061/Year=2024/Month=2/*.csv.gz"))


def test_bus_job(spark, tmp_path, feeds):
    (tmp_path / "new.csv").write_text("service_date,route_id,direction,half_trip_id,stop_id,time_point_id,time_point_order,point_type,standard_type,scheduled,actual,scheduled_headway,headway\n2024-02-07,01,Inbound,11,67,maput,2,Midpoint,Schedule,1900-01-01 05:08:00,1900-01-01 05:09:07,-5,\n2024-02-07,01,Inbound,11,67,maput,2,Midpoint,Headway,1900-01-01 05:08:00,,,\n")
    (tmp_path / "old.csv").write_text("ServiceDate,Route,Direction,HalfTripId,Stop,Timepoint,TimepointOrder,PointType,StandardType,Scheduled,Actual,ScheduledHeadway,Headway\n2024-02-06,77,Outbound,12,68,x,1,Startpoint,Schedule,1900-01-02 00:08:00,1900-01-02 00:09:07,,\n")
    out = str(tmp_path / "out")
    jobs.run_bus(spark, [str(tmp_path / "new.csv"), str(tmp_path / "old.csv")], *feeds, out)
    rows = spark.read.option("header", True).csv(out).collect()
    assert {(r.key, r.event_type, str(r.event_time), r.stop_sequence) for r in rows} == {("1-1-67", "ARR", "2024-02-07 05:09:07", "2"), ("1-1-67", "DEP", "2024-02-07 05:09:07", "2"), ("77-0-68", "DEP", "2024-02-07 00:09:07", "1")}
    assert set(rows[0].asDict()) >= set(S.BUS_OUTPUT)
    jobs.run_bus(spark, [str(tmp_path / "new.csv"), str(tmp_path / "old.csv")], *feeds, str(tmp_path / "one"), routes=["77"], compressed=False)
    assert spark.read.option("header", True).csv(str(tmp_path / "one")).count() == 1


def test_ferry_job(spark, tmp_path, feeds):
    (tmp_path / "f.csv").write_text("service_date,route_id,trip_id,travel_direction,departure_terminal,arrival_terminal,mbta_sched_arrival,mbta_sched_departure,actual_arrival,actual_departure,vessel_time_slot\n2024-02-08 00:00:00+00:00,F1,,From Boston,Hingham,Rowes,2024-02-07 08:00:00+00:00,2024-02-07 07:30:00+00:00,2024-02-07 08:02:00,2024-02-07 07:31:00,slot1\n")
    out = str(tmp_path / "out")
    jobs.run_ferry(spark, [str(tmp_path / "f.csv")], *feeds, out)
    rows = {r.key: r for r in spark.read.option("header", True).csv(out).collect()}
    assert set(rows) == {"Boat-F1|0|Boat-Hingham", "Boat-F1|0|Boat-Rowes"}
    assert rows["Boat-F1|0|Boat-Hingham"].scheduled_tt == "0" and rows["Boat-F1|0|Boat-Rowes"].scheduled_tt is None and str(rows["Boat-F1|0|Boat-Hingham"].service_date)[:10] == "2024-02-07"


def test_benchmark_job(spark, tmp_path):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(4)]
    for kind, pairs in (("traveltimes", {"A_B": 91, "B_C": 100}), ("dwells", {"B_C": 15, "B_X": 999})):
        (tmp_path / kind / "red").mkdir(parents=True)
        for pair, value in pairs.items():
            text = "service_date,50%\n" + "".join(f"{d},{value}\n" for d in days)
            (tmp_path / kind / "red" / f"{pair}.csv.gz").write_bytes(gzip.compress(text.encode()))
    jobs.run_benchmarks(spark, str(tmp_path / "traveltimes"), str(tmp_path / "dwells"), str(tmp_path / "out"), min_days=4)
    row = spark.read.text(str(tmp_path / "out")).first()
    assert row.color == "red" and json.loads(row.value) == {"color": "red", "benchmarks": {"A|B": 120, "A|C": 210, "B|C": 120}}


def _pad(path, line, rows=150_000):
    """Lines of trips that no other table has, so that the file goes beyond one split."""
    with open(path, "a") as f:
        f.writelines(line.format(i) for i in range(rows))


def test_timetable_files_of_several_splits(spark, feeds, any_split):
    """tables of more than one split give all their rows to the expansion."""
    for table, line in (("stop_times", "other{0},70061,09:00:00,09:00:00\n"), ("trips", "other{0},Red,none,weekday,0\n")):
        _pad(f"{feeds[0]}/20240201/{table}.txt", line)
    days, tables = [dt.date(2024, 2, 7), dt.date(2024, 3, 6)], readers.gtfs(spark, feeds[0])
    dates = schedule.feed_of_dates(spark.createDataFrame([(d,) for d in days], "service_date date"), readers.feed_index(spark, feeds[1]))
    _, stops = schedule.expand(schedule.active_services(dates, tables["calendar"], tables["calendar_dates"]), tables["trips"], tables["stop_times"])
    assert {(r.route_id, r["count"]) for r in stops.groupBy("variant", "route_id").count().collect()} == {("Red", 4), ("1", 1), ("Boat-F1", 1)}
    assert tables["trips"].filter("trip_id like 'other%'").count() == tables["stop_times"].filter("trip_id like 'other%'").count() == 150_000


def test_bus_job_on_files_of_several_splits(spark, tmp_path, feeds, any_split):
    """bus files and timetable tables of more than one split, to events with their schedule."""
    (tmp_path / "new.csv").write_text("service_date,route_id,direction,half_trip_id,stop_id,time_point_id,time_point_order,point_type,standard_type,scheduled,actual,scheduled_headway,headway\n2024-02-07,01,Outbound,11,67,maput,2,Midpoint,Schedule,1900-01-01 05:08:00,1900-01-01 05:09:07,-5,\n")
    _pad(tmp_path / "new.csv", "2024-02-07,01,Outbound,a{0},67,maput,2,Midpoint,Schedule,1900-01-01 05:08:00,,-5,\n", 80_000)
    _pad(f"{feeds[0]}/20240201/stop_times.txt", "other{0},70061,09:00:00,09:00:00\n")
    jobs.run_bus(spark, [str(tmp_path / "new.csv")], *feeds, str(tmp_path / "out"))
    rows = spark.read.option("header", True).csv(str(tmp_path / "out")).collect()
    assert {(r.key, r.event_type, str(r.event_time), r.stop_sequence, r.scheduled_tt) for r in rows} == {("1-0-67", kind, "2024-02-07 05:09:07", "2", "0") for kind in ("ARR", "DEP")}


def test_daily_job_on_timetables_of_several_splits(spark, tmp_path, feeds, any_split):
    """the travel times of a daily file come from a timetable whose tables go beyond one split."""
    _pad(f"{feeds[0]}/20240201/stop_times.txt", "other{0},70061,09:00:00,09:00:00\n")
    _daily_file(spark, str(tmp_path / "2024-02-07.parquet"), dt.date(2024, 2, 7))
    refresh.backfill(spark, str(tmp_path), *feeds, str(tmp_path / "out"), dt.date(2024, 2, 7), dt.date(2024, 2, 7), lambda r, d: f"{r}/{d}.parquet")
    rows = spark.read.option("header", True).csv(str(tmp_path / "out")).collect()
    assert {(str(r.stop), r.event_type, float(r.scheduled_tt or -1)) for r in rows} == {("70061", "ARR", 0.0), ("70061", "DEP", 0.0), ("70063", "ARR", 300.0)}


def test_subway_job_on_timetables_of_several_splits(spark, tmp_path, feeds, any_split):
    """events meet their schedule when its tables go beyond one split."""
    _pad(f"{feeds[0]}/20240201/stop_times.txt", "other{0},70061,09:00:00,09:00:00\n")
    (tmp_path / "a.csv").write_text("service_date,route_id,trip_id,direction_id,stop_id,stop_sequence,vehicle_id,vehicle_label,event_type,event_time_sec\n2024-02-07,Red,t1,0,70061,1,R-001,1801,DEP,28800\n2024-02-07,Red,t1,0,70063,2,R-001,1801,ARR,29130\n")
    jobs.run_subway(spark, [str(tmp_path / "a.csv")], False, *feeds, str(tmp_path / "out"))
    rows = spark.read.option("header", True).csv(str(tmp_path / "out")).collect()
    assert {(str(r.stop), r.scheduled_trip_id, r.scheduled_tt) for r in rows} == {("70061", "sched1", "0"), ("70063", "sched1", "300")}
