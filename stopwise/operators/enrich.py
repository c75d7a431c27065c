"""Daily events against the day's timetable: branches, matched trips, travel times, smoothed headways.

All operators work on many service dates at once; every key starts with the service date.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import timeutil as tu
from ..functions.storage import materialize
from .asof import SLICE_ROWS, asof_join
from .schedule import first_events

_KEYS = list(S.ROUTE_DIRECTION_STOP)


def trip_branch(trip_keys: Sequence[str], order: Sequence[str], route: str = "route_id", stop: str = "stop_id", branched: str = S.BRANCHED_ROUTE, branches: Mapping[str, Sequence[str]] = S.BRANCH_STOPS) -> Column:
    """The branch that a trip's stops show: of a trip whose first route has branches, the only one it visits, else the first route.

    order: columns that say which of the trip's rows is first.
    """
    w = Window.partitionBy(*trip_keys)
    first = F.min_by(route, F.struct(*order, route)).over(w)
    visits = {name: F.coalesce(F.bool_or(F.col(stop).isin(*stops)).over(w), F.lit(False)) for name, stops in branches.items()}
    out = F.when(first != branched, first)
    for name, here in visits.items():
        others = [v for n, v in visits.items() if n != name]
        alone = here
        for o in others:
            alone = alone & ~o
        out = out.when(alone, F.lit(name))
    return out.otherwise(first)


def match_daily_schedule(events: DataFrame, stops: DataFrame, slice_rows: int | None = SLICE_ROWS, flags: bool = False) -> DataFrame:
    """Replace scheduled_tt by the matched scheduled trip's.

    events: S.DAILY_OUTPUT, event_time an instant. stops: service_date, trip_id, stop_id, arrival_time
    (seconds), route_id, direction_id: the day's scheduled stop events, of which only trips seen that day are
    candidates. A trip's first event is matched to the nearest scheduled arrival of its route, direction,
    stop and branch; travel times are then looked up by scheduled trip and stop, and where that trip doesn't
    stop there, the median of the half hour at the route, direction and stop stands in. slice_rows: see asof_join.
    flags: append scheduled_trip_id, and filled where that median was taken.
    """
    seen = events.select("service_date", "trip_id").distinct()
    stops = stops.join(seen, ["service_date", "trip_id"], "left_semi").withColumn("direction_id", F.col("direction_id").cast("smallint"))
    trip = ["service_date", "trip_id"]
    stops = stops.withColumn("branch", trip_branch(trip, ["arrival_time", "stop_id"]))
    stops = stops.withColumn("scheduled_tt", F.col("arrival_time") - F.min("arrival_time").over(Window.partitionBy(*trip)))
    events = events.drop("scheduled_tt").withColumn("branch", trip_branch(trip, ["event_type", "stop_sequence", "event_time"]))
    events = events.withColumn("arrival_time", tu.elapsed_since_midnight(F.col("event_time"), F.col("service_date")))
    events = match_trips(events, stops, ["service_date", *_KEYS, "branch"], "event_time", "arrival_time", ["stop_sequence", "stop_id"], slice_rows)
    events = fill_travel_time(events.withColumn("filled", F.col("scheduled_tt").isNull()), stops).withColumn("filled", F.col("filled") & F.col("scheduled_tt").isNotNull())
    return events.select(*S.DAILY_OUTPUT, *(("scheduled_trip_id", "filled") if flags else ()))


def match_trips(events: DataFrame, stops: DataFrame, by: Sequence[str], time: str, seconds: str, ties: Sequence[str], slice_rows: int | None = None) -> DataFrame:
    """Append scheduled_trip_id, of the scheduled arrival nearest to the trip's first event, and that trip's scheduled_tt at the stop.

    Trips are named by service_date and trip_id on both sides. time, ties: what makes an event the first; seconds: where arrivals stand.
    """
    trip = ["service_date", "trip_id"]
    starts = first_events(events, trip, time, list(ties)).select(*by, "trip_id", seconds)
    candidates = stops.select(*by, seconds, F.col("trip_id").alias("scheduled_trip_id")).distinct()
    if slice_rows is not None:  # the histogram reads them, too
        starts, candidates = materialize(starts), materialize(candidates)
    found = asof_join(starts, candidates, seconds, by, ["scheduled_trip_id"], "nearest", tie_break=["scheduled_trip_id"], slice_rows=slice_rows)
    events = events.join(found.select(*trip, "scheduled_trip_id"), trip, "left")
    visits = stops.select("service_date", F.col("trip_id").alias("scheduled_trip_id"), "stop_id", "scheduled_tt")
    return events.join(visits, ["service_date", "scheduled_trip_id", "stop_id"], "left")


def fill_travel_time(events: DataFrame, stops: DataFrame, keys: Sequence[str] = ("service_date", *S.ROUTE_DIRECTION_STOP), seconds: str = "arrival_time", value: str = "scheduled_tt") -> DataFrame:
    """Where value is null, the median of the schedule's values in the same half hour under the same keys."""
    usual = stops.withColumn("__bucket", tu.bucket_of(F.col(seconds))).groupBy(*keys, "__bucket").agg(F.median(value).alias("__usual"))
    events = events.withColumn("__bucket", tu.bucket_of(F.col(seconds))).join(usual, [*keys, "__bucket"], "left")
    return events.withColumn(value, F.coalesce(F.col(value).cast("double"), F.col("__usual"))).drop("__bucket", "__usual")


def smooth_headways(events: DataFrame, value: str = "scheduled_headway", keys: Sequence[str] = ("service_date", *S.ROUTE_DIRECTION_STOP)) -> DataFrame:
    """Replace headways by the mean of their half hour under the keys, to ten seconds (half to even).

    Events outside the 48.5 hours from midnight of the service date go. The half hours follow the wall clock.
    """
    events = events.withColumn("__bucket", tu.clock_bucket(F.col("event_time"), F.col("service_date"))).filter("__bucket is not null")
    mean = tu.round_half_even(F.avg(value).over(Window.partitionBy(*keys, "__bucket")))
    # rows with a null key belong to no group
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return events.withColumn(value, F.when(whole, mean)).drop("__bucket")
