import datetime as dt

from pyspark.sql import functions as F

from stopwise import schemas as S
from stopwise.operators import enrich, shaping
from stopwise.sources import writers


def _daily(spark, rows):
    base = dict.fromkeys(S.DAILY_INPUT) | {"service_date": 20240207, "route_id": "Red", "trip_id": "trip1", "direction_id": 0, "vehicle_id": "R-001", "vehicle_label": "1801", "scheduled_headway_trunk": 290}
    schema = ", ".join(f"{c} {S.DAILY_TYPES[c]}" for c in S.DAILY_INPUT)
    return spark.createDataFrame([tuple((base | r)[c] for c in S.DAILY_INPUT) for r in rows], schema)


def test_departures_move_to_the_stop_before(spark):
    rows = [
        {"stop_sequence": 360, "stop_id": "a", "stop_timestamp": 100, "move_timestamp": 50},
        {"stop_sequence": 370, "stop_id": "b", "stop_timestamp": 300, "move_timestamp": 200},
        {"stop_sequence": 380, "stop_id": "c", "move_timestamp": 400},
    ]
    got = {(r.event_type, r.stop_sequence): r.stop_id for r in shaping.shape_daily(_daily(spark, rows)).collect()}
    assert got == {("ARR", 360): "a", ("ARR", 370): "b", ("DEP", 360): None, ("DEP", 370): "a", ("DEP", 380): "b"}


def test_aliases_and_non_revenue_trips(spark):
    rows = [
        {"stop_sequence": 1, "stop_id": "Alewife-01", "stop_timestamp": 100},
        {"stop_sequence": 1, "stop_id": "x", "stop_timestamp": 100, "trip_id": "NONREV-1"},
        {"stop_sequence": 1, "stop_id": "y", "stop_timestamp": 100, "trip_id": "NONREV-1", "service_date": 20231101},
        {"stop_sequence": 1, "stop_id": "z", "stop_timestamp": 100, "trip_id": "NONREV-2", "service_date": 20231130},
    ]
    got = shaping.shape_daily(_daily(spark, rows)).collect()
    assert sorted(r.stop_id for r in got) == ["70061", "x", "z"]
    assert {r.service_date for r in got} == {dt.date(2024, 2, 7), dt.date(2023, 11, 30)}


def test_branches(spark):
    rows = [("t1", "Red", "70061", 1), ("t1", "Red", "70085", 2), ("t2", "Red", "70095", 1), ("t3", "Red", "70061", 1), ("t3", "Red", "70063", 2), ("t4", "Orange", "70085", 1), ("t5", "Red", "70085", 1), ("t5", "Red", "70095", 2)]
    df = spark.createDataFrame(rows, "trip_id string, route_id string, stop_id string, n int")
    got = {r.trip_id: r.b for r in df.select("trip_id", enrich.trip_branch(["trip_id"], ["n"]).alias("b")).collect()}
    assert got == {"t1": "Red-A", "t2": "Red-B", "t3": "Red", "t4": "Orange", "t5": "Red"}


def _bus(spark, rows):
    cols = "service_date string, route_id string, direction_id string, half_trip_id string, stop_id string, time_point_id string, time_point_order int, point_type string, standard_type string, scheduled string, actual string, scheduled_headway int, headway int, source_file string"
    base = {"direction_id": "Inbound", "half_trip_id": "46374001", "stop_id": "67", "time_point_id": "maput", "time_point_order": 2, "point_type": "Midpoint", "standard_type": "Schedule", "route_id": "01", "source_file": "f"}
    return spark.createDataFrame([tuple((base | r).get(c.split()[0]) for c in cols.split(", ")) for r in rows], cols)


def test_bus_times(spark):
    rows = [
        {"service_date": "2020-01-15", "actual": "1900-01-02 01:35:00", "source_file": "a"},
        {"service_date": "2024-01-15", "actual": "1900-01-01T08:06:00Z", "source_file": "b"},
        {"service_date": "2024-07-15", "actual": "1900-01-01T10:06:00Z", "source_file": "c"},
        {"service_date": "2024-07-15", "actual": None, "source_file": "c"},
        {"service_date": "2024-05-31", "actual": "1900-01-01T10:06:00Z", "source_file": "c", "route_id": "99"},
    ]
    got = {r.source_file: (r.actual, r.route_id, r.direction_id) for r in shaping.clean_bus(_bus(spark, rows), ["1"], "source_file").collect()}
    assert got == {"a": (dt.datetime(2020, 1, 16, 1, 35), "1", 1), "b": (dt.datetime(2024, 1, 15, 8, 6), "1", 1), "c": (dt.datetime(2024, 7, 15, 6, 6), "1", 1)}


def test_bus_event_types(spark):
    rows = [(p, i) for i, p in enumerate(("Startpoint", "Midpoint", "Endpoint", "Other"))]
    df = spark.createDataFrame(rows, "point_type string, stop_sequence int").withColumns({c: F.lit(None).cast("string") for c in S.BUS_OUTPUT if c not in ("stop_sequence", "event_type", "vehicle_id", "vehicle_label")})
    got = sorted((r.stop_sequence, r.event_type or "") for r in shaping.bus_events(df).collect())
    assert got == [(0, "DEP"), (1, "ARR"), (1, "DEP"), (2, "ARR"), (3, "")]


def _ferry(spark, days, **changes):
    cols = "service_date route_id trip_id travel_direction departure_terminal arrival_terminal mbta_sched_arrival mbta_sched_departure actual_arrival actual_departure vessel_time_slot".split()
    rows = [tuple(({"service_date": f"2024-02-{d:02} 00:00:00+00:00", "route_id": "F1", "trip_id": f"trip{d}", "travel_direction": "To Boston", "departure_terminal": "Hingham", "arrival_terminal": "Rowes", "mbta_sched_arrival": "2024-02-07 08:00:00+00:00", "mbta_sched_departure": "2024-02-07 07:30:00+00:00", "actual_arrival": "2024-02-07 08:02:00", "actual_departure": "2024-02-07 07:31:00", "vessel_time_slot": "slot1"} | changes)[c] for c in cols) for d in days]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


def test_ferry_dates_shift_before_the_filter(spark):
    got = shaping.ferry_events(_ferry(spark, [5, 7, 10]), "2024-02-06", "2024-02-08").collect()
    assert {(r.trip_id, r.service_date, r.stop_id, r.event_type, r.event_time) for r in got} == {
        ("trip7", dt.date(2024, 2, 6), "Boat-Rowes", "ARR", dt.datetime(2024, 2, 7, 8, 2)),
        ("trip7", dt.date(2024, 2, 6), "Boat-Hingham", "DEP", dt.datetime(2024, 2, 7, 7, 31)),
    }
    assert {(r.route_id, r.direction_id) for r in got} == {("Boat-F1", 1)}


def test_ferry_without_trip_id(spark):
    got = shaping.ferry_events(_ferry(spark, [5], trip_id=None)).collect()
    assert len({r.trip_id for r in got}) == 1 and got[0].trip_id


def test_smoothing_keeps_rows_and_rounds_half_to_even(spark):
    rows = [(1, "a", 440.0), (2, "a", 450.0), (3, "a", None), (4, None, 7.0)]
    df = spark.createDataFrame(rows, "id int, stop_id string, scheduled_headway double").withColumns({"service_date": F.lit("2024-02-07").cast("date"), "route_id": F.lit("r"), "direction_id": F.lit(0), "event_time": F.lit("2024-02-07 17:05:00").cast("timestamp")})
    assert {r.id: r.scheduled_headway for r in enrich.smooth_headways(df).collect()} == {1: 440.0, 2: 440.0, 3: 440.0, 4: None}


def test_sinks_skip_null_keys_and_replace_only_their_own(spark, tmp_path):
    rows = [("a", "2024-02-07", 1), ("b", "2024-02-07", 2), (None, "2024-02-07", 3)]
    df = spark.createDataFrame(rows, "stop_id string, service_date string, n int").withColumns({"service_date": F.col("service_date").cast("date"), "event_time": F.col("n")})
    out = str(tmp_path / "out")
    writers.write_daily(df, out)
    writers.write_daily(df.filter("stop_id = 'a'").withColumn("n", F.lit(9)), out)
    back = spark.read.option("header", True).csv(out)
    assert {(r.stop, r.n, r.Day) for r in back.collect()} == {("a", "9", 7), ("b", "2", 7)}
