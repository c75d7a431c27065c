import datetime as dt

import pytest

from stopwise.operators import enrich, schedule
from stopwise.plans import jobs

DAY = dt.date(2024, 2, 7)


@pytest.fixture()
def tables(spark):
    week = [1, 1, 1, 1, 1, 0, 0]
    days = "monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int"
    out = {
        "calendar": spark.createDataFrame([("f", "weekday", *week, dt.date(2024, 1, 1), dt.date(2024, 12, 31)), ("f", "weekend", *[1 - x for x in week], dt.date(2024, 1, 1), dt.date(2024, 12, 31))], f"feed_id string, service_id string, {days}, start_date date, end_date date"),
        "calendar_dates": spark.createDataFrame([("f", "special", DAY, 2)], "feed_id string, service_id string, date date, exception_type int"),
        "trips": spark.createDataFrame([("f", "Red", "weekday", f"sched{i}", 0) for i in (1, 2, 3)], "feed_id string, route_id string, service_id string, trip_id string, direction_id int"),
        "stop_times": spark.createDataFrame([("f", f"sched{i}", "stop1", f"08:{i - 1}0:00") for i in (1, 2, 3)], "feed_id string, trip_id string, stop_id string, arrival_time string"),
    }
    feeds = spark.createDataFrame([("f", dt.date(2024, 2, 1), dt.date(2024, 2, 28), 0), ("g", dt.date(2024, 2, 1), dt.date(2024, 2, 28), 1)], "feed_id string, start date, end date, position long")
    return out, feeds


def _events(spark, rows):
    return spark.createDataFrame(rows, "service_date date, route_id string, trip_id string, direction_id int, stop_id string, event_time timestamp_ntz")


def test_enrichment(spark, tables):
    rows = [(DAY, "Red", f"trip{i}", 0, "stop1", dt.datetime(2024, 2, 7, 8, 10 * (i - 1))) for i in (1, 2, 3, 4)]
    got = {r.trip_id: (r.scheduled_headway, r.scheduled_trip_id, r.scheduled_tt) for r in jobs.with_schedule(_events(spark, rows), *tables).collect()}
    assert got == {"trip1": (None, "sched1", 0), "trip2": (600, "sched2", 0), "trip3": (600, "sched3", 0), "trip4": (600, "sched3", 0)}


def test_missing_schedules(spark, tables):
    other = dt.date(2025, 2, 7)
    rows = [(DAY, "Red", "t", 0, "stop1", dt.datetime(2024, 2, 7, 8)), (DAY, "Red", "u", 0, None, dt.datetime(2024, 2, 7, 8)), (other, "Red", "t", 0, "stop1", dt.datetime(2025, 2, 7, 8))]
    kept = jobs.with_schedule(_events(spark, rows), *tables)
    assert kept.count() == 3 and kept.filter("scheduled_trip_id is null").count() == 2
    assert jobs.with_schedule(_events(spark, rows), *tables, on_missing="drop").count() == 1
    assert jobs.with_schedule(_events(spark, rows[2:]), *tables, on_missing="drop").count() == 0


def test_first_feed_in_order_and_weekday_services(spark, tables):
    dates = schedule.feed_of_dates(spark.createDataFrame([(DAY,), (dt.date(2024, 2, 10),), (dt.date(2023, 1, 1),)], "service_date date"), tables[1])
    assert {r.service_date.day: r.feed_id for r in dates.collect()} == {7: "f", 10: "f", 1: None}
    services = schedule.active_services(dates, tables[0]["calendar"], tables[0]["calendar_dates"])
    assert {(r.service_date.day, r.service_id) for r in services.collect()} == {(7, "weekday"), (10, "weekend")}


def test_dates_with_the_same_services_share_a_variant(spark, tables):
    dates = schedule.feed_of_dates(spark.createDataFrame([(dt.date(2024, 2, d),) for d in (5, 6, 7, 10)], "service_date date"), tables[1])
    days, stops = schedule.expand(schedule.active_services(dates, tables[0]["calendar"], tables[0]["calendar_dates"]), tables[0]["trips"], tables[0]["stop_times"])
    assert days.count() == 4 and days.select("variant").distinct().count() == 2 and stops.count() == 3


def test_headway_of_a_day_and_an_hour(spark):
    df = spark.createDataFrame([("r", 0, "s", "a", 0), ("r", 0, "s", "b", 90000)], "route_id string, direction_id int, stop_id string, trip_id string, arrival_time int")
    assert {r.trip_id: r.h for r in df.select("trip_id", schedule.scheduled_headway(df).alias("h")).collect()} == {"a": None, "b": 3600}


def test_daily_match_falls_back_to_the_half_hour_median(spark):
    from stopwise import schemas as S

    base = {"service_date": DAY, "route_id": "Red", "direction_id": 0, "event_type": "ARR", "vehicle_id": "v", "scheduled_headway": 300}
    at = lambda s: dt.datetime(2024, 2, 7, 5) + dt.timedelta(seconds=s)
    rows = [base | {"trip_id": "p", "stop_id": "A", "stop_sequence": 1, "event_time": at(28800)}, base | {"trip_id": "p", "stop_id": "B", "stop_sequence": 2, "event_time": at(29000)}, base | {"trip_id": "q", "stop_id": "C", "stop_sequence": 1, "event_time": at(30000)}]
    types = S.DAILY_TYPES | {"service_date": "date", "event_time": "timestamp", "event_type": "string", "headway_seconds": "bigint", "headway_branch_seconds": "bigint", "scheduled_tt": "bigint", "scheduled_headway": "bigint", "scheduled_headway_branch": "bigint"}
    events = spark.createDataFrame([tuple(r.get(c) for c in S.DAILY_OUTPUT) for r in rows], ", ".join(f"{c} {types[c]}" for c in S.DAILY_OUTPUT))
    stops = spark.createDataFrame([(DAY, "p", "A", 28790, "Red", 0), (DAY, "q", "A", 20000, "Red", 0), (DAY, "q", "B", 29100, "Red", 0), (DAY, "gone", "A", 28800, "Red", 0)], "service_date date, trip_id string, stop_id string, arrival_time long, route_id string, direction_id int")
    got = {(r.trip_id, r.stop_id): r.scheduled_tt for r in enrich.match_daily_schedule(events, stops).collect()}
    # trip "gone" isn't seen, so p matches p; p doesn't stop at B, q's time there stands in; C is unknown
    assert got == {("p", "A"): 0.0, ("p", "B"): 9100.0, ("q", "C"): None}


def test_service_ranges_leave_no_pair_outside(spark, tables):
    """What the join of dates and services puts out is the result: the range is tested within it."""
    dates = spark.createDataFrame([(DAY + dt.timedelta(days=i), "f") for i in range(-60, 400)], "service_date date, feed_id string")
    got = schedule.active_services(dates, tables[0]["calendar"], tables[0]["calendar_dates"])
    want = sorted((d, "weekday" if d.weekday() < 5 else "weekend") for d in (DAY + dt.timedelta(days=i) for i in range(-60, 400)) if d.year == 2024)
    assert sorted((r.service_date, r.service_id) for r in got.collect()) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    join = next(x for x in plan.splitlines() if "Join Inner" in x and "weekday" in x)
    assert "start_date" in join and "end_date" in join and "month" in join
