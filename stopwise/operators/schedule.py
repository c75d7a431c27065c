"""Timetables: feed versions, active services, schedules shared by dates, and matching of historic events to them.

Dates that run the same services of the same feed share one schedule variant, so a year of dates needs a
few copies of a timetable instead of one for each date; events are matched by (variant, route, direction,
stop) on seconds since midnight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import timeutil as tu
from ..functions.storage import materialize
from .asof import SLICE_ROWS, asof_join

_KEYS = list(S.ROUTE_DIRECTION_STOP)


def feed_of_dates(dates: DataFrame, feeds: DataFrame, date: str = "service_date") -> DataFrame:
    """Append feed_id (null if none): of the feeds whose dates hold the date, the first in index order.

    dates: distinct dates; feeds: feed_id, start, end (dates), position. A feed becomes a row per day, so that
    dates meet feeds in an equality join.
    """
    days = feeds.filter("start <= end").select("feed_id", "position", F.explode(F.sequence("start", "end", F.expr("INTERVAL 1 DAY"))).alias(date))
    first = days.groupBy(date).agg(F.min_by("feed_id", "position").alias("feed_id"))
    return dates.join(first, date, "left")


def active_services(dates: DataFrame, calendar: DataFrame, calendar_dates: DataFrame, date: str = "service_date") -> DataFrame:
    """Rows (date, feed_id, service_id): regular services of the weekday less the removed ones, plus the added ones.

    dates: date, feed_id. calendar: feed_id, service_id, monday.. sunday (0/1), start_date, end_date (dates);
    calendar_dates: feed_id, service_id, date, exception_type (1: added, 2: removed). An addition wins over a removal.
    """
    days = F.explode(F.array(*[F.when(F.col(d) == 1, F.lit(d)) for d in S.WEEKDAYS])).alias("weekday")
    months = F.explode(F.sequence(F.trunc("start_date", "month"), F.trunc("end_date", "month"), F.expr("INTERVAL 1 MONTH")))
    runs = calendar.filter("start_date <= end_date").select("feed_id", "service_id", "start_date", "end_date", days).filter("weekday is not null").select("*", months.alias("month"))
    # a run is met by the dates of its own months alone, and its range is tested within the join
    today = dates.select(F.col(date).alias("__day"), F.col("feed_id").alias("__feed"), tu.weekday(F.col(date)).alias("__weekday"), F.trunc(date, "month").alias("__month"))
    met = (F.col("__feed") == F.col("feed_id")) & (F.col("__weekday") == F.col("weekday")) & (F.col("__month") == F.col("month")) & F.col("__day").between(F.col("start_date"), F.col("end_date"))
    regular = today.join(runs, met).select(F.col("__day").alias(date), "feed_id", "service_id").distinct()
    changes = dates.join(calendar_dates.withColumnRenamed("date", date), ["feed_id", date]).select(date, "feed_id", "service_id", "exception_type")
    keys = [date, "feed_id", "service_id"]
    removed = changes.filter("exception_type = 2").select(*keys)
    added = changes.filter("exception_type = 1").select(*keys)
    return regular.join(removed, keys, "left_anti").unionByName(added).distinct()


def variants(services: DataFrame, date: str = "service_date") -> DataFrame:
    """Append variant: a name of the set of services that a date runs in its feed."""
    names = services.groupBy(date, "feed_id").agg(F.sha2(F.concat_ws("|", F.first("feed_id").cast("string"), F.array_join(F.array_sort(F.collect_set("service_id")), "|")), 256).alias("variant"))
    return services.join(names, [date, "feed_id"])


def expand(services: DataFrame, trips: DataFrame, stop_times: DataFrame, date: str = "service_date") -> tuple[DataFrame, DataFrame]:
    """Schedules by variant: (dates with their variant, stop events with variant, trip, stop, seconds, route, direction).

    trips: feed_id, trip_id, route_id, service_id, direction_id; stop_times: feed_id, trip_id, stop_id, arrival_time (text).
    """
    named = variants(services, date)
    days = named.select(date, "variant").distinct()
    # one date stands for all dates of its variant
    sets = named.select("variant", "feed_id", "service_id").distinct()
    running = trips.join(sets, ["feed_id", "service_id"]).select("variant", "feed_id", "trip_id", "route_id", F.col("direction_id").cast("int").alias("direction_id"))
    stops = stop_times.select("feed_id", "trip_id", "stop_id", tu.seconds_of_time(F.col("arrival_time")).cast("long").alias("arrival_time"))
    return days, stops.join(running, ["feed_id", "trip_id"]).drop("feed_id")


def scheduled_headway(stops: DataFrame, extra_keys: tuple[str, ...] = (), time: str = "arrival_time", trip: str = "trip_id") -> Column:
    """Seconds since the scheduled arrival before at the same route, direction and stop, by the clock (a day's difference is none)."""
    w = Window.partitionBy(*extra_keys, *_KEYS).orderBy(F.col(time).asc_nulls_last(), trip)
    return F.pmod(F.col(time) - F.lag(time).over(w), F.lit(86400))


def scheduled_travel_time(extra_keys: tuple[str, ...] = (), time: str = "arrival_time", trip: str = "trip_id", by_clock: bool = True) -> Column:
    """Seconds since the scheduled start of the trip."""
    since = F.col(time) - F.min(time).over(Window.partitionBy(*extra_keys, trip))
    return F.pmod(since, F.lit(86400)) if by_clock else since


def first_events(events: DataFrame, trip_keys: list[str], time: str, ties: list[str]) -> DataFrame:
    """The row of each trip with the earliest time (ties by further columns); trips without id have none."""
    row = F.struct(*[F.col(f"`{c}`") for c in events.columns])
    usable = events.filter(F.col(trip_keys[-1]).isNotNull() & F.col(time).isNotNull())
    return usable.groupBy(*[F.col(k).alias(f"__{k}") for k in trip_keys]).agg(F.min_by(row, F.struct(time, *ties)).alias("r")).select("r.*")


def add_schedule(events: DataFrame, days: DataFrame, stops: DataFrame, on_missing: str = "keep", slice_rows: int | None = SLICE_ROWS) -> DataFrame:
    """Append arrival_time (seconds), scheduled_headway, scheduled_trip_id, trip_id_gtfs and scheduled_tt to historic events.

    events: service_date (date), route, direction, stop, trip, event_time (wall clock). days, stops: from expand().
    on_missing: events of dates without schedule, or with a null key or time, are kept with nulls ("keep") or dropped ("drop").
    slice_rows: rows that one task takes of a key (a key holds all dates of its variant), see asof_join; None: all.
    A trip that visits a stop twice in the schedule gives one row for each visit.
    """
    if on_missing not in ("keep", "drop"):
        raise ValueError("on_missing is keep or drop")
    events = events.join(days, "service_date", "left").withColumn("direction_id", F.col("direction_id").cast("int"))
    # several joins read the events and the timetable
    events = materialize(events.withColumn("arrival_time", tu.wall_seconds(F.col("event_time"), F.col("service_date"))))
    clean = F.col("variant").isNotNull() & F.col("arrival_time").isNotNull()
    for k in _KEYS:
        clean = clean & F.col(k).isNotNull()
    usable, others = events.filter(clean), events.filter(~clean)
    timed = stops.withColumn("scheduled_headway", scheduled_headway(stops, ("variant",))).withColumn("scheduled_tt", scheduled_travel_time(("variant",)))
    timed = materialize(timed.dropna(subset=[*_KEYS, "arrival_time"]))
    by = ["variant", *_KEYS]
    final = asof_join(usable, timed.select(*by, "arrival_time", "scheduled_headway", "trip_id"), "arrival_time", by, ["scheduled_headway"], tie_break=["trip_id"], slice_rows=slice_rows)
    starts = first_events(usable, ["service_date", "trip_id"], "event_time", ["stop_id"]).select("service_date", *by, "trip_id", "arrival_time")
    scheduled = timed.select(*by, "arrival_time", F.col("trip_id").alias("scheduled_trip_id"))
    matched = asof_join(starts, scheduled, "arrival_time", by, ["scheduled_trip_id"], "nearest", tie_break=["scheduled_trip_id"], slice_rows=slice_rows)
    final = final.join(matched.select("service_date", "trip_id", "scheduled_trip_id"), ["service_date", "trip_id"], "left")
    visits = timed.select(*by, F.col("trip_id").alias("scheduled_trip_id"), "scheduled_tt", F.col("trip_id").alias("trip_id_gtfs"))
    final = final.join(visits, [*by, "scheduled_trip_id"], "left")
    if on_missing == "keep":
        final = final.unionByName(others, allowMissingColumns=True)
    return final.drop("variant")
