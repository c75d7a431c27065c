"""Shaping of stop records into events, and the cleaning steps around it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import timeutil as tu
from ..functions.joins import join_checked
from .asof import asof_join


def map_values(c: Column, mapping: Mapping, keep_others: bool = True) -> Column:
    """Replace values by a table; others stay, or become null."""
    found = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])[c]
    return F.coalesce(found, c) if keep_others else found


def non_revenue(trip: Column, date: Column, prefix: str = S.NON_REVENUE_PREFIX, cutoff: str = S.NON_REVENUE_CUTOFF) -> Column:
    """True for trips with the prefix before the cutoff (null for a trip without id before it)."""
    return trip.startswith(prefix) & (date < F.lit(cutoff).cast("date"))


def drop_non_revenue(df: DataFrame, trip: str = "trip_id", date: str = "service_date", prefix: str = S.NON_REVENUE_PREFIX, cutoff: str = S.NON_REVENUE_CUTOFF) -> DataFrame:
    """Drop trips with the prefix before the cutoff (a trip without id before it goes, too)."""
    return df.filter(~non_revenue(F.col(trip), F.col(date).cast("date"), prefix, cutoff))


def with_stop(df: DataFrame, stop: str = "stop_id") -> DataFrame:
    """Rows that name a stop."""
    return df.filter(F.col(stop).isNotNull())


def in_date_range(df: DataFrame, date: str = "service_date", start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows from start to end inclusive; either may be open."""
    if start is not None:
        df = df.filter(F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(date) <= F.lit(end).cast("date"))
    return df


def only_routes(df: DataFrame, routes: Sequence[str] | None, route: str = "route_id") -> DataFrame:
    """Strip leading zeros of route ids; keep the listed routes (an empty list: all)."""
    df = df.withColumn(route, F.ltrim(F.col(route), F.lit("0")))
    return df.filter(F.col(route).isin(*routes)) if routes else df


def arrivals_and_departures(
    records: DataFrame,
    keys: Sequence[str] = ("service_date", "route_id", "trip_id", "vehicle_id", "direction_id"),
    sequence: str = "stop_sequence",
    stop: str = "stop_id",
    arrived: str = "arr_time",
    departed: str = "dep_time",
    others: Sequence[str] = (),
) -> DataFrame:
    """One row per arrival and per departure: keys, stop, sequence, event_type, event_time, others.

    A record's departure is the departure from the stop before it: its stop becomes that of the last record
    of the same trip that arrived, at a strictly smaller sequence (null if there is none).
    """
    cols = [*keys, sequence, *others]
    arr = records.filter(F.col(arrived).isNotNull()).select(*cols, F.col(stop), F.lit("ARR").alias("event_type"), F.col(arrived).alias("event_time"))
    dep = records.filter(F.col(departed).isNotNull()).select(*cols, F.lit("DEP").alias("event_type"), F.col(departed).alias("event_time"))
    dep = asof_join(dep, arr.select(*keys, sequence, stop), on=sequence, by=keys, right_cols=[stop], allow_exact=False, tie_break=[stop])
    return arr.unionByName(dep)


def shape_daily(records: DataFrame) -> DataFrame:
    """Daily stop records (of any number of dates) to events: names, types, aliases, dropped trips, arrivals and departures.

    event_time is the instant; service_date a date.
    """
    df = records.select(*S.DAILY_INPUT).withColumnsRenamed(S.DAILY_RENAMES)
    df = df.withColumns(
        {
            "direction_id": F.col("direction_id").cast("smallint"),
            "service_date": tu.to_date_from_int(F.col("service_date")),
            "stop_id": map_values(F.col("stop_id"), S.STOP_ALIASES),
            "dep_time": F.timestamp_seconds("move_timestamp"),
            "arr_time": F.timestamp_seconds("stop_timestamp"),
        }
    )
    df = drop_non_revenue(df)
    keys = ("service_date", "route_id", "trip_id", "vehicle_id", "direction_id")
    others = [c for c in S.DAILY_OUTPUT if c not in (*keys, "stop_id", "stop_sequence", "event_type", "event_time")]
    return arrivals_and_departures(df, keys, others=others).select(*S.DAILY_OUTPUT)


def shape_subway(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Monthly subway rows to events: date range, wall-clock time from seconds, one name for the sequence."""
    df = in_date_range(df, start=start, end=end).withColumnRenamed("sync_stop_sequence", "stop_sequence")
    return df.withColumn("event_time", tu.plus_seconds(F.col("service_date"), F.col("event_time_sec"))).drop("event_time_sec")


def clean_bus(df: DataFrame, routes: Sequence[str] | None = None, file: str | None = None) -> DataFrame:
    """Bus rows with names of one era: only observed ones, wanted routes, times moved onto the service date.

    Files whose first service date is in June 2024 or later hold UTC; a file's own rows (column `file`; none:
    all rows are one file) decide, after the filters.
    """
    df = df.filter(F.col("actual").isNotNull())
    df = only_routes(df, routes).withColumn("stop_id", F.col("stop_id").cast("string")).withColumn("service_date", F.to_date("service_date"))
    df = df.withColumn("__file", F.coalesce(F.col(file), F.lit("")) if file else F.lit(""))
    # one row per file, combined before the shuffle: no task holds a file
    first = df.groupBy("__file").agg((F.min("service_date") >= F.lit("2024-06-01").cast("date")).alias("__utc"))
    df = join_checked(df, first, ["__file"])
    for c in ("scheduled", "actual"):
        moved = tu.placeholder_time(F.col("service_date"), _clock(F.col(c)))
        eastern = F.from_utc_timestamp(moved.cast("timestamp"), S.ZONE).cast("timestamp_ntz")
        df = df.withColumn(c, F.when(F.col("__utc"), eastern).otherwise(moved))
    return df.drop("__utc", "__file").withColumn("direction_id", map_values(F.col("direction_id"), S.BUS_DIRECTIONS, keep_others=False))


def _clock(c: Column) -> Column:
    """The clock reading of a text or timestamp, a trailing Z ignored."""
    return F.try_to_timestamp(F.regexp_replace(F.regexp_replace(c.cast("string"), "T", " "), "Z$", "")).cast("timestamp_ntz")


def bus_event_shape(df: DataFrame) -> DataFrame:
    """Bus rows under the names of events, without what events don't have."""
    df = df.drop("time_point_id", "standard_type", "scheduled", "scheduled_headway", "headway")
    return df.withColumnsRenamed({"half_trip_id": "trip_id", "time_point_order": "stop_sequence", "actual": "event_time"})


def bus_events(df: DataFrame, point: str = "point_type") -> DataFrame:
    """One row per event of a time point: departures at the start, arrivals at the end, both between (another type: one row, null event)."""
    names = F.create_map(*chain.from_iterable((F.lit(k), F.array(*map(F.lit, v))) for k, v in S.BUS_EVENTS.items()))
    df = df.withColumns({"vehicle_id": F.lit(""), "vehicle_label": F.lit("")})
    return df.withColumn("event_type", F.explode_outer(names[F.col(point)])).select(*S.BUS_OUTPUT)


def fill_trip_id(df: DataFrame, keys: Sequence[str], trip: str = "trip_id") -> DataFrame:
    """Missing trip ids become a hash of the row's own values: the same in every run, shared by a row's events."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys])
    return df.withColumn(trip, F.coalesce(F.col(trip), F.sha2(text.cast("binary"), 256)))


def ferry_events(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Ferry rows to events: needed values present, dates in local time, codes mapped, an arrival and a departure per row."""
    df = df.dropna(subset=S.FERRY_REQUIRED)
    df = fill_trip_id(df, ["service_date", "route_id", "travel_direction", "departure_terminal", "arrival_terminal", "mbta_sched_departure", "vessel_time_slot"])
    utc_day = F.to_date(F.from_utc_timestamp(F.try_to_timestamp("service_date"), S.ZONE))
    df = df.withColumn("service_date", utc_day)
    df = in_date_range(df, start=start, end=end)
    clock = lambda c: F.date_trunc("second", _clock(F.col(c)).cast("timestamp")).cast("timestamp_ntz")
    shared = {
        "direction_id": map_values(F.col("travel_direction").cast("string"), {k: str(v) for k, v in S.FERRY_DIRECTIONS.items()}).cast("int"),
        "route_id": map_values(F.col("route_id"), S.FERRY_ROUTES),
    }
    df = df.withColumns(shared)
    side = lambda kind, terminal, time: F.struct(map_values(F.col(terminal), S.FERRY_TERMINALS).alias("stop_id"), F.lit(kind).alias("event_type"), clock(time).alias("event_time"))
    both = F.explode(F.array(side("ARR", "arrival_terminal", "actual_arrival"), side("DEP", "departure_terminal", "actual_departure"))).alias("e")
    none = F.lit(None).cast("string")
    out = df.select("service_date", "route_id", "trip_id", "direction_id", F.col("vessel_time_slot").alias("vehicle_id"), both)
    return out.select("*", "e.*").drop("e").withColumns({"stop_sequence": none.cast("int"), "vehicle_label": none, "vehicle_consist": none}).select(*S.FERRY_OUTPUT)
