"""Refresh of service dates: each run recomputes whole dates and replaces their folders.

Matches to the nearest scheduled arrival and branches of trips change until a day is over, so a day is
computed anew instead of being kept as stream state; a rerun leaves what one run with the rows as they are now
would: late rows come in, and folders of stops that have no rows any more are cleared.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import SparkSession

from ..functions import timeutil as tu
from ..functions.storage import exists
from ..plans import jobs


def refresh(spark: SparkSession, root: str, gtfs_root: str, feed_index: str, output: str, days_back: int = 0, path_of: Callable[[str, str], str] | None = None) -> None:
    """Ingest today's service date (or that of some days back) again."""
    backfill(spark, root, gtfs_root, feed_index, output, *[tu.current_service_date(spark, days_back)] * 2, path_of=path_of)


def dates_between(start: date, end: date) -> list[date]:
    return [start + timedelta(days=i) for i in range((end - start).days + 1)]


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those paths that are there, files or folders, whatever file system they name. Each wanted name is asked for; nothing beside it is listed."""
    return [p for p in paths if exists(spark, p)]


def backfill(spark: SparkSession, root: str, gtfs_root: str, feed_index: str, output: str, start: date, end: date, path_of: Callable[[str, str], str] | None = None) -> list[str]:
    """Ingest all dates of a range in one plan; missing days are left out. Returns the inputs used."""
    from ..sources.readers import daily_path

    days = {(path_of or daily_path)(root, d.isoformat()): d for d in dates_between(start, end)}
    found = existing(spark, list(days))
    if found:
        jobs.run_daily(spark, found, gtfs_root, feed_index, output, [days[p] for p in found])
    return found
