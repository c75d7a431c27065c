"""Queries that run the jobs from files to files over the given tables, and their SQL.

The tables become the files that a job reads (several header eras, a byte order mark, gzip, mixed types), the job
writes its output, and the query gives what is read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas as S
from .functions.storage import for_small_files, materialize, shared_dir
from .operators import schedule
from .operators.asof import asof_join
from .plans import jobs
from .queries import _BY, _E, _INGEST, _NEAREST, _NET, _WEEK, _asof_sql, _network, _sink_events, _write_feeds, _write_index, daily_files, historic_sql, query, stop_records
from .sources import readers, writers

_CLOCK = "yyyy-MM-dd HH:mm:ss"


def _timetable(spark: SparkSession, root: str, e: DataFrame) -> tuple[str, str]:
    """Timetable files in which each date runs its own service, and the index of the one feed."""
    stops = e.filter("is_scheduled")
    clock = F.concat_ws(":", F.floor(F.col("secs") / 3600).cast("string"), *[F.lpad(c.cast("string"), 2, "0") for c in (F.floor(F.col("secs") / 60) % 60, F.col("secs") % 60)])
    feed, service = F.lit("all").alias("feed_id"), F.col("service_date").cast("string").alias("service_id")
    _write_feeds(
        f"{root}/gtfs",
        trips=stops.select("route_id", service, feed, "trip_id", "direction_id").distinct(),
        stop_times=stops.select(feed, "trip_id", "stop_id", clock.alias("arrival_time"), clock.alias("departure_time")),
        calendar=stops.limit(1).select(feed, F.lit("none").alias("service_id"), *[F.lit(0).alias(w) for w in _WEEK], F.lit("19900101").alias("start_date"), F.lit("20991231").alias("end_date")),
        calendar_dates=e.select(feed, service, F.date_format("service_date", "yyyyMMdd").alias("date"), F.lit(1).alias("exception_type")).distinct(),
    )
    _write_index(spark, [("all", "1990-01-01", "2099-12-31", 0)], f"{root}/index")
    return f"{root}/gtfs", f"{root}/index"


def _numbers(df: DataFrame, key: str, *more: str) -> DataFrame:
    number = lambda c: F.col(c).cast("double").cast("long").alias(c)
    return df.select(F.col(key).cast("long").alias("event_id"), *more, number("scheduled_headway"), number("scheduled_tt"))


@query(f"SELECT event_id, scheduled_headway, scheduled_trip_id, scheduled_tt FROM ({historic_sql('true')})")
def run_subway(spark, sf_dir):
    """Monthly subway files of both layouts, to events by stop and month."""
    root = shared_dir(spark)
    e = materialize(stop_records(spark, sf_dir))
    feeds = _timetable(spark, root, e)
    values = {"service_date": F.col("service_date").cast("string"), "vehicle_id": F.lit("v"), "vehicle_label": F.col("event_id"), "event_type": F.lit("DEP"), "event_time_sec": F.col("secs"), "stop_sequence": F.lit(1)}
    for layout, (names, half) in enumerate(((S.SUBWAY_INPUT, "service_date < '2024-01-16'"), (S.SUBWAY_INPUT_2024, "service_date >= '2024-01-16'"))):
        rows = e.filter(f"not is_scheduled and {half}")
        cols = [values.get(c, F.col(c)).alias(n) for c, n in zip(S.SUBWAY_INPUT, names, strict=True)]
        rows.select(*cols, F.lit("x").alias("other")).write.option("header", True).csv(f"{root}/in{layout}")
        jobs.run_subway(spark, [f"{root}/in{layout}"], bool(layout), *feeds, f"{root}/out{layout}")
    back = readers.csv(spark, [f"{root}/out0", f"{root}/out1"], recursive=True)
    return _numbers(back, "vehicle_label", "scheduled_trip_id")


@query(f"""SELECT h.event_id, t.event_type, h.scheduled_headway, h.scheduled_tt FROM ({historic_sql('event_id % 11 <> 0')}) h
JOIN (VALUES (0, 'DEP'), (1, 'ARR'), (1, 'DEP'), (2, 'ARR')) AS t(point, event_type) ON t.point = h.event_id % 3 + CASE WHEN h.event_id % 5 = 0 THEN -1 ELSE 0 END""")
def run_bus(spark, sf_dir):
    """Bus files of two header eras, one with a byte order mark, rows without an actual time among them, to events by route, direction, stop and month."""
    root = shared_dir(spark)
    e = materialize(stop_records(spark, sf_dir))
    feeds = _timetable(spark, root, e)
    point = F.element_at(F.array(*map(F.lit, ("Startpoint", "Midpoint", "Endpoint"))), (F.col("event_id") % 3 + F.when(F.col("event_id") % 5 == 0, 0).otherwise(1)).cast("int"))
    time = F.concat(F.lit("1900-01-01 "), F.date_format(F.col("ts").cast("timestamp"), "HH:mm:ss"))
    new = {
        "service_date": F.col("service_date").cast("string"),
        "route_id": F.concat(F.lit("0"), F.col("route_id")),
        "direction": F.when(F.col("direction_id") == 0, "Outbound").otherwise("Inbound"),
        "half_trip_id": F.col("trip_id"),
        "stop_id": F.col("stop_id"),
        "time_point_id": F.lit("p"),
        "time_point_order": F.col("event_id"),
        "point_type": point,
        "standard_type": F.when(F.col("event_id") % 2 == 0, "Headway").otherwise("Schedule"),
        "scheduled": time,
        "actual": F.when(F.col("event_id") % 11 != 0, time),
        "scheduled_headway": F.lit(-5),
        "headway": F.lit(None).cast("int"),
    }
    old = "﻿ServiceDate Route Direction HalfTripId Stop Timepoint TimepointOrder PointType StandardType Scheduled Actual ScheduledHeadway Headway".split(" ")
    seen = e.filter("not is_scheduled")
    seen.filter("user_id % 3 = 0").select(*[c.alias(n) for n, c in zip(old, new.values(), strict=True)]).write.option("header", True).csv(f"{root}/in/old")
    seen.filter("user_id % 3 <> 0").select(*[c.alias(n) for n, c in reversed(new.items())]).write.option("header", True).csv(f"{root}/in/new")
    jobs.run_bus(spark, [f"{root}/in/old", f"{root}/in/new"], *feeds, f"{root}/out", compressed=False)
    return _numbers(readers.csv(spark, f"{root}/out"), "stop_sequence", "event_type")


@query(f"SELECT event_id, scheduled_headway, scheduled_tt FROM ({historic_sql('event_id % 17 <> 0')})")
def run_ferry(spark, sf_dir):
    """Ferry rows, some without a needed value, to events by route, direction, stop and month; arrivals without a terminal have no folder."""
    root = shared_dir(spark)
    e = materialize(stop_records(spark, sf_dir))
    feeds = _timetable(spark, root, e)
    at = F.date_format(F.col("ts").cast("timestamp"), _CLOCK)
    rows = e.filter("not is_scheduled").select(
        F.concat(F.col("service_date").cast("string"), F.lit(" 12:00:00+00:00")).alias("service_date"),
        "route_id",
        "trip_id",
        F.when(F.col("direction_id") == 0, "From Boston").otherwise("To Boston").alias("travel_direction"),
        F.col("stop_id").alias("departure_terminal"),
        F.lit(None).cast("string").alias("arrival_terminal"),
        F.when(F.col("event_id") % 17 != 0, at).alias("mbta_sched_arrival"),
        at.alias("mbta_sched_departure"),
        at.alias("actual_arrival"),
        at.alias("actual_departure"),
        F.col("event_id").alias("vessel_time_slot"),
    )
    rows.write.option("header", True).csv(f"{root}/in")
    jobs.run_ferry(spark, [f"{root}/in"], *feeds, f"{root}/out")
    return _numbers(readers.csv(spark, f"{root}/out"), "vehicle_id")


@query(f"""SELECT event_id, scheduled_headway, scheduled_trip_id, scheduled_tt FROM ({historic_sql('event_id % 13 <> 0')})
UNION ALL SELECT event_id, NULL, NULL, NULL FROM events WHERE event_id % 3 <> 0 AND event_id % 13 = 0""")
def null_keys(spark, sf_dir):
    """Events without a route or a time match nothing and are kept."""
    e = stop_records(spark, sf_dir)
    broken = F.col("event_id") % 13 == 0
    events = e.filter("not is_scheduled").withColumns({"event_time": F.when(~broken | (F.col("event_id") % 2 == 0), F.date_trunc("second", "ts").cast("timestamp_ntz")), "route_id": F.when(~broken | (F.col("event_id") % 2 == 1), F.col("route_id"))})
    days = e.select("service_date", F.col("service_date").cast("string").alias("variant")).distinct()
    stops = e.filter("is_scheduled").select(F.col("service_date").cast("string").alias("variant"), "trip_id", "stop_id", F.col("secs").alias("arrival_time"), "route_id", "direction_id")
    return schedule.add_schedule(events, days, stops).select("event_id", "scheduled_headway", "scheduled_trip_id", "scheduled_tt")


@query(_asof_sql("", _NEAREST))
def asof_nearest_busy(spark, sf_dir):
    """Keys cut where a histogram finds more than a few rows."""
    e = stop_records(spark, sf_dir)
    right = e.filter("is_scheduled").select(*_BY, "secs", F.col("event_id").alias("match_id"), F.col("secs").alias("match_secs"))
    left = e.filter("not is_scheduled").select("event_id", *_BY, "secs")
    return asof_join(left, right, "secs", _BY, ["match_id", "match_secs"], "nearest", True, ["match_id"], slice_rows=5).select("event_id", "match_id", "match_secs")


@query(f"""{_E} SELECT event_id, stop_id AS stop, row_number() OVER (PARTITION BY stop_id, service_date ORDER BY date_trunc('second', ts), event_id) - 1 AS place FROM e WHERE stop_id <> 'error'""")
def sink_order(spark, sf_dir):
    """Each row's place in the files of its key, busy keys cut into several files."""
    path = shared_dir(spark)
    events = _sink_events(spark, sf_dir)
    writers.write_daily(events, path, order=["event_time", "event_id"], rows_per_file=40)
    reader = for_small_files(spark).read.option("header", True).schema(", ".join(f"{c} string" for c in events.columns))
    back = writers.read_placed(reader, path, ["stop", "Year", "Month", "Day"])
    return back.select(F.col("event_id").cast("long").alias("event_id"), F.col("stop").cast("string").alias("stop"), F.col("place").cast("long").alias("place"))


@query(f"""{_E} SELECT event_id, stop_id, CASE WHEN service_date >= DATE '2024-01-10' THEN 'second' ELSE 'first' END AS run FROM e
WHERE stop_id <> 'error' AND NOT (service_date >= DATE '2024-01-10' AND stop_id IN ('click', 'view') AND user_id % 2 >= 0)""")
def reingest_removed_stop(spark, sf_dir):
    """All dates once; then the later ones again, of which two stops have lost all events: their folders go, those of other dates stay."""
    path = shared_dir(spark)
    events = _sink_events(spark, sf_dir)
    days = events.select("service_date").distinct()
    writers.write_daily(events.withColumn("run", F.lit("first")), path, days)
    later = "service_date >= '2024-01-10'"
    writers.write_daily(events.filter(f"{later} and stop_id not in ('click', 'view')").withColumn("run", F.lit("second")), path, days.filter(later))
    back = spark.read.option("header", True).csv(path)
    return back.select(F.col("event_id").cast("long").alias("event_id"), F.col("stop").alias("stop_id"), "run")


@query(f"""{_NET}, f AS (SELECT color, from_stop, min(to_stop) AS to_stop FROM seg GROUP BY ALL)
SELECT color, from_stop, to_stop, strftime(service_date, '%Y-%m-%d') AS service_date, p50 FROM seg JOIN f USING (color, from_stop, to_stop)""")
def first_file_per_stop(spark, sf_dir):
    """Percentile files of pairs; of those of one stop the first by name counts."""
    path = shared_dir(spark)
    segments, _ = _network(spark, sf_dir)
    segments.select("color", F.concat_ws("_", "from_stop", "to_stop").alias("pair"), "service_date", F.col("p50").alias("50%")).repartition("color", "pair").write.partitionBy("color", "pair").option("header", True).option("compression", "gzip").csv(path)
    out = readers.first_file_per_stop(readers.pair_percentiles(spark, path, r"color=([^/]+)/pair=([^_/]+)_([^/]+)/[^/]+$"))
    return out.select("color", "from_stop", "to_stop", F.col("service_date").cast("string").alias("service_date"), "p50")


_COUNTED = (
    _INGEST.replace("user_id || '-' || ts::DATE AS trip_id", "CASE WHEN user_id % 7 = 0 THEN 'NONREV-' ELSE '' END || user_id || '-' || ts::DATE AS trip_id")
    .replace("NOT is_scheduled AND stop_id <> 'error'", "NOT is_scheduled AND stop_id <> 'error' AND NOT (user_id % 7 = 0 AND service_date < DATE '2024-01-09')")
)


@query(f"""{_COUNTED}, u AS (SELECT DISTINCT service_date, route_id, direction_id, stop_id, secs // 1800 AS bucket FROM v),
raw AS (SELECT *, user_id % 7 = 0 AND service_date < DATE '2024-01-09' AS gone FROM e WHERE NOT is_scheduled)
SELECT (SELECT count(*) FROM raw) AS rows, (SELECT count(*) FROM raw WHERE gone) AS non_revenue, (SELECT count(*) FROM raw WHERE NOT gone AND stop_id = 'error') AS without_stop,
  (SELECT count(*) FROM x WHERE scheduled_trip_id IS NULL) AS unmatched,
  (SELECT count(*) FROM x JOIN u ON u.service_date = x.service_date AND u.route_id = x.route_id AND u.direction_id = x.direction_id AND u.stop_id = x.stop_id AND u.bucket = x.secs // 1800 WHERE x.scheduled_tt IS NULL) AS filled""")
def daily_counts(spark, sf_dir):
    """What a run of the daily job counts: rows read, dropped as non-revenue, dropped without a stop, events without a scheduled trip, travel times filled in."""
    root = shared_dir(spark)
    e = stop_records(spark, sf_dir).withColumn("trip_id", F.concat(F.when(F.col("user_id") % 7 == 0, "NONREV-").otherwise(""), "trip_id"))
    # 40 days earlier, so that the last date of non-revenue trips lies within
    e = e.withColumns({"service_date": F.date_sub("service_date", 40), "ts": F.col("ts") - F.expr("INTERVAL 40 DAYS")})
    inputs, *feeds = daily_files(spark, e, root)
    days = [r[0] for r in e.filter("not is_scheduled").select("service_date").distinct().collect()]
    jobs.run_daily(spark, [inputs(d) for d in sorted(days)], *feeds, f"{root}/out", days)
    return spark.read.parquet(f"{root}/out/_counts").select(*jobs.COUNTS)
