"""The jobs: daily ingest, historic subway, bus and ferry, travel-time benchmarks.

Each is one lazy plan over all its dates or files and one write. With on_missing="keep", dates without a
timetable keep their events with empty schedule columns, and other dates are not affected.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.storage import materialize
from ..operators import enrich, paths, schedule, shaping
from ..sources import readers, writers


#: What a run of the daily job counts.
COUNTS = ("rows", "non_revenue", "without_stop", "unmatched", "filled")


def daily_events(records: DataFrame, stops: DataFrame, counts: dict[str, Observation] | None = None) -> DataFrame:
    """Daily stop records and the dates' scheduled stop events (service_date, trip, stop, arrival, route, direction) to finished events.

    counts gets an Observation for each plan node that counts (see `count_row`). The shaped events are written once, as matching reads them several times.
    """
    seen = {} if counts is None else counts
    seen |= {k: Observation(f"{k}-{uuid.uuid4().hex}") for k in ("records", "shaped", "matched")}
    gone = F.coalesce(shaping.non_revenue(F.col("trip_id"), shaping.tu.to_date_from_int(F.col("service_date"))), F.lit(True))
    records = records.observe(seen["records"], F.count(F.lit(1)).alias("rows"), F.count_if(gone).alias("non_revenue"))
    events = shaping.shape_daily(records).observe(seen["shaped"], F.count_if(F.col("stop_id").isNull()).alias("without_stop"))
    matched = enrich.match_daily_schedule(materialize(shaping.with_stop(events)), stops, flags=True)
    unmatched, filled = F.col("scheduled_trip_id").isNull(), F.col("filled")
    matched = matched.observe(seen["matched"], F.count_if(unmatched).alias("unmatched"), F.count_if(filled).alias("filled"))
    return enrich.smooth_headways(matched.select(*S.DAILY_OUTPUT))


def count_row(spark: SparkSession, counts: dict[str, Observation]) -> DataFrame:
    """One row (run_at and COUNTS) of what the Observations saw, once the events of daily_events have been written."""
    seen = {k: v for o in counts.values() for k, v in o.get.items()}
    row = spark.createDataFrame([tuple(seen[c] for c in COUNTS)], ", ".join(f"{c} long" for c in COUNTS))
    return row.select(F.current_timestamp().alias("run_at"), *COUNTS)


def dated_stops(seen: DataFrame, tables: dict[str, DataFrame], feeds: DataFrame) -> DataFrame:
    """Scheduled stop events of each date, of the trips seen that day (distinct rows service_date, trip_id)."""
    seen = seen.join(schedule.feed_of_dates(seen.select("service_date").distinct(), feeds), "service_date")
    trips = tables["trips"].select("feed_id", "trip_id", "route_id", F.col("direction_id").cast("smallint").alias("direction_id"))
    stops = tables["stop_times"].select("feed_id", "trip_id", "stop_id", shaping.tu.seconds_of_time(F.col("arrival_time")).cast("long").alias("arrival_time"))
    return stops.join(trips.join(seen, ["feed_id", "trip_id"]), ["feed_id", "trip_id"]).drop("feed_id")


def run_daily(spark: SparkSession, inputs: Sequence[str], gtfs_root: str, feed_index: str, output: str, dates: Sequence[date] = ()) -> None:
    """Ingest daily files: events by stop and day below output, a row of counts in output/_counts. dates: those recomputed, beside the ones that have records."""
    records = readers.daily_records(spark, inputs)
    seen = materialize(records.select(shaping.tu.to_date_from_int(F.col("service_date")).alias("service_date"), "trip_id").distinct())
    stops = dated_stops(seen, readers.gtfs(spark, gtfs_root), readers.feed_index(spark, feed_index))
    scope = seen.select("service_date").unionByName(spark.createDataFrame([(d,) for d in dates], "service_date date")).distinct()
    counts: dict[str, Observation] = {}
    writers.write_daily(daily_events(records, stops, counts), output, scope)
    count_row(spark, counts).coalesce(1).write.mode("append").parquet(f"{output.rstrip('/')}/_counts")


def with_schedule(events: DataFrame, tables: dict[str, DataFrame], feeds: DataFrame, on_missing: str = "keep") -> DataFrame:
    """Historic events with scheduled headway and travel time: feed of each date, its services, their variants, as-of matches."""
    dates = schedule.feed_of_dates(events.select("service_date").distinct(), feeds)
    services = schedule.active_services(dates.filter("feed_id is not null"), tables["calendar"], tables["calendar_dates"])
    days, stops = schedule.expand(services, tables["trips"], tables["stop_times"])
    return schedule.add_schedule(events, days, stops, on_missing)


def run_subway(spark: SparkSession, inputs: Sequence[str], from_2024: bool, gtfs_root: str, feed_index: str, output: str, start: str | None = None, end: str | None = None, compressed: bool = True, on_missing: str = "keep") -> None:
    events = shaping.shape_subway(readers.subway_month(spark, inputs, from_2024), start, end)
    writers.write_monthly(with_schedule(events, readers.gtfs(spark, gtfs_root), readers.feed_index(spark, feed_index), on_missing), output, compressed)


def run_bus(spark: SparkSession, inputs: Sequence[str], gtfs_root: str, feed_index: str, output: str, routes: Sequence[str] | None = None, compressed: bool = True, on_missing: str = "keep") -> None:
    rows = shaping.bus_event_shape(shaping.clean_bus(readers.bus_rows(spark, inputs), routes, "source_file"))
    events = with_schedule(rows, readers.gtfs(spark, gtfs_root), readers.feed_index(spark, feed_index), on_missing)
    writers.write_bus(shaping.bus_events(events), output, compressed)


def run_ferry(spark: SparkSession, inputs: Sequence[str], gtfs_root: str, feed_index: str, output: str, start: str | None = None, end: str | None = None, compressed: bool = True, on_missing: str = "keep") -> None:
    events = shaping.ferry_events(readers.ferry_rows(spark, inputs), start, end)
    writers.write_ferry(with_schedule(events, readers.gtfs(spark, gtfs_root), readers.feed_index(spark, feed_index), on_missing), output, compressed)


def benchmarks(segments: DataFrame, dwells: DataFrame, min_days: int = 365, step: int = 30, max_length: int = 200) -> DataFrame:
    """Travel-time benchmarks of all downstream stop pairs of all colours."""
    found = paths.simple_paths(paths.edges(segments), max_length)
    return paths.pair_benchmarks(paths.daily_path_values(found, segments, dwells), min_days, step)


def run_benchmarks(spark: SparkSession, segment_root: str, dwell_root: str, output: str, min_days: int = 365) -> None:
    segments = readers.pair_percentiles(spark, segment_root)
    dwells = readers.first_file_per_stop(readers.pair_percentiles(spark, dwell_root))
    writers.write_benchmarks(paths.benchmark_documents(benchmarks(segments, dwells, min_days)), output)
