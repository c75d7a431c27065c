"""Time rules: service dates, date integers, times past midnight, half-hour buckets across daylight saving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ZONE

HALF_HOUR = 1800


def to_date_from_int(c: Column) -> Column:
    """20240207 -> 2024-02-07 (null if it is no date)."""
    return F.to_date(F.try_to_timestamp(c.cast("string"), F.lit("yyyyMMdd")))


def date_int(c: Column) -> Column:
    """2024-02-07 -> 20240207."""
    return F.date_format(c, "yyyyMMdd").cast("int")


def local_time(epoch_seconds: Column, zone: str = ZONE) -> Column:
    """Wall clock of an instant given in epoch seconds."""
    return F.from_utc_timestamp(F.timestamp_seconds(epoch_seconds), zone)


def service_date(wall_clock: Column, starts_at: int = 3) -> Column:
    """A service date runs from 03:00 to 03:00; its first hours of the night belong to the day before."""
    return F.to_date(wall_clock - F.expr(f"INTERVAL {starts_at} HOURS"))


def current_service_date(spark: SparkSession, days_back: int = 0, zone: str = ZONE):
    """Today's service date (or that of some days back), fixed on the driver."""
    now = F.from_utc_timestamp(F.current_timestamp(), zone)
    return spark.range(1).select(F.date_sub(service_date(now), days_back)).first()[0]


def plus_seconds(date_: Column, seconds: Column) -> Column:
    """Wall clock that many seconds after the start of a date."""
    return date_.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def seconds_of_time(text: Column) -> Column:
    """'25:10:00' -> 90600: hours may go past 24 (null if the text is no time)."""
    parts = F.split(F.trim(text), ":")
    n = [F.get(parts, F.lit(i)).try_cast("int") for i in range(3)]
    return n[0] * 3600 + n[1] * 60 + n[2]


def elapsed_since_midnight(instant: Column, date_: Column, zone: str = ZONE) -> Column:
    """Seconds that passed since local midnight of a date: on days when clocks change an hour off the wall clock."""
    midnight = F.to_utc_timestamp(date_.cast("timestamp"), zone)
    return F.unix_timestamp(instant) - F.unix_timestamp(midnight)


def wall_seconds(wall_clock: Column, date_: Column) -> Column:
    """Difference of clock readings between a wall clock and the start of a date, in seconds."""
    return F.unix_timestamp(wall_clock.cast("timestamp")) - F.unix_timestamp(date_.cast("timestamp"))


def bucket_of(seconds: Column, width: int = HALF_HOUR) -> Column:
    return F.floor(seconds / width).cast("int")


def clock_bucket(instant: Column, date_: Column, zone: str = ZONE) -> Column:
    """Half-hour bucket by wall clock, 0 to 96 from midnight of the service date (null outside).

    When clocks go back, the second pass of the repeated hour counts to the bucket of 01:30, which is thus
    90 minutes long; when they go forward, the skipped buckets stay empty.
    """
    wall = F.from_utc_timestamp(instant, zone)
    again = F.to_utc_timestamp(wall, zone) != instant
    day = F.datediff(F.to_date(wall), date_)
    bucket = day * 48 + F.when(again, F.lit(3)).otherwise(F.hour(wall) * 2 + F.floor(F.minute(wall) / 30))
    return F.when(bucket.between(0, 96), bucket.cast("int"))


def placeholder_time(date_: Column, placeholder: Column) -> Column:
    """Time of day and day offset stored on a date of January 1900, moved onto a service date."""
    interval = F.make_dt_interval(F.dayofmonth(placeholder) - 1, F.hour(placeholder), F.minute(placeholder), F.second(placeholder).cast("decimal(18,6)"))
    return date_.cast("timestamp_ntz") + interval


def weekday(date_: Column) -> Column:
    return F.lower(F.date_format(date_, "EEEE"))


def ceil_to(c: Column, step: int) -> Column:
    return (F.ceil(c / step) * step).cast("int")


def round_half_even(c: Column, step_power: int = -1) -> Column:
    return F.bround(c, step_power)


def date_range(spark: SparkSession, start: str, end: str, months: bool = False) -> DataFrame:
    """One row per day, or per first of month, from start to end inclusive."""
    a, b = F.lit(start).cast("date"), F.lit(end).cast("date")
    step = F.expr("INTERVAL 1 MONTH" if months else "INTERVAL 1 DAY")
    if months:
        a, b = F.trunc(a, "month"), F.trunc(b, "month")
    return spark.range(1).select(F.explode(F.sequence(a, b, step)).alias("date"))
