"""Queries of the transit operators over the given tables, and their SQL.

Stop records come from `events` by one projection in both engines: a trip is a user's day, the route and
direction follow from the user, the stop is the event type; every third event stands for the timetable,
the others for what was observed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import schemas as S
from .functions import timeutil as tu
from .functions.storage import materialize, shared_dir
from .operators import enrich, paths, schedule, shaping
from .operators.asof import asof_join
from .plans import jobs
from .sources import readers, writers
from .streaming import refresh

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _seconds(ts) -> F.Column:
    return (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("long")


def stop_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events")
    day = F.col("ts").cast("date")
    return ev.select(
        "event_id",
        "user_id",
        F.concat(F.col("user_id").cast("string"), F.lit("-"), day.cast("string")).alias("trip_id"),
        F.concat(F.lit("R"), (F.col("user_id") % 4).cast("string")).alias("route_id"),
        (F.col("user_id") % 2).cast("int").alias("direction_id"),
        F.col("event_type").alias("stop_id"),
        "ts",
        day.alias("service_date"),
        _seconds("ts").alias("secs"),
        (F.col("event_id") % 3 == 0).alias("is_scheduled"),
    )


_E = """WITH e AS (
    SELECT event_id, user_id, user_id || '-' || ts::DATE AS trip_id, 'R' || (user_id % 4) AS route_id, (user_id % 2)::INT AS direction_id,
           event_type AS stop_id, ts, ts::DATE AS service_date, (hour(ts) * 3600 + minute(ts) * 60 + second(ts))::BIGINT AS secs,
           event_id % 3 = 0 AS is_scheduled
    FROM events),
o AS (SELECT * FROM e WHERE NOT is_scheduled),
s AS (SELECT * FROM e WHERE is_scheduled)"""
_BY = ["service_date", "route_id", "direction_id", "stop_id"]
_SAME = "s.service_date = o.service_date AND s.route_id = o.route_id AND s.direction_id = o.direction_id AND s.stop_id = o.stop_id"


def _matched(spark: SparkSession, sf_dir: str, direction: str, exact: bool, slice_width: float | None = None) -> DataFrame:
    e = stop_records(spark, sf_dir)
    right = e.filter("is_scheduled").select(*_BY, "secs", F.col("event_id").alias("match_id"), F.col("secs").alias("match_secs"))
    left = e.filter("not is_scheduled").select("event_id", *_BY, "secs")
    return asof_join(left, right, "secs", _BY, ["match_id", "match_secs"], direction, exact, ["match_id"], slice_width).select("event_id", "match_id", "match_secs")


def _asof_sql(cond: str, order: str) -> str:
    return f"""{_E},
m AS (SELECT o.event_id, s.event_id AS match_id, s.secs AS match_secs, row_number() OVER (PARTITION BY o.event_id ORDER BY {order}) AS n
      FROM o LEFT JOIN s ON {_SAME}{cond})
SELECT event_id, match_id, match_secs FROM m WHERE n = 1"""


_NEAREST = "abs(s.secs - o.secs), s.secs > o.secs, CASE WHEN s.secs > o.secs THEN s.event_id ELSE -s.event_id END"


@query(_asof_sql(" AND s.secs < o.secs", "s.secs DESC, s.event_id DESC"))
def asof_backward_exclusive(spark, sf_dir):
    return _matched(spark, sf_dir, "backward", False)


@query(_asof_sql(" AND s.secs <= o.secs", "s.secs DESC, s.event_id DESC"))
def asof_backward(spark, sf_dir):
    return _matched(spark, sf_dir, "backward", True)


@query(_asof_sql("", _NEAREST))
def asof_nearest(spark, sf_dir):
    return _matched(spark, sf_dir, "nearest", True)


@query(_asof_sql("", _NEAREST))
def asof_nearest_sliced(spark, sf_dir):
    """The same by slices of three hours, as for keys too large for one task."""
    return _matched(spark, sf_dir, "nearest", True, 10800.0)


_RECORDS = """r AS (SELECT event_id, service_date, route_id, trip_id, user_id AS vehicle_id, direction_id, secs AS stop_sequence, stop_id,
        CASE WHEN event_id % 5 <> 0 THEN ts END AS arr_time, CASE WHEN event_id % 7 <> 0 THEN ts + INTERVAL 30 SECOND END AS dep_time FROM e)"""


@query(f"""{_E}, {_RECORDS},
d AS (SELECT r.event_id, a.stop_id, r.stop_sequence, r.dep_time, row_number() OVER (PARTITION BY r.event_id ORDER BY a.stop_sequence DESC, a.stop_id DESC) AS n
      FROM r LEFT JOIN r a ON a.trip_id = r.trip_id AND a.arr_time IS NOT NULL AND a.stop_sequence < r.stop_sequence WHERE r.dep_time IS NOT NULL)
SELECT event_id, stop_id, stop_sequence, 'ARR' AS event_type, arr_time AS event_time FROM r WHERE arr_time IS NOT NULL
UNION ALL SELECT event_id, stop_id, stop_sequence, 'DEP', dep_time FROM d WHERE n = 1""")
def arr_dep_shaping(spark, sf_dir):
    e = stop_records(spark, sf_dir)
    r = e.withColumns(
        {
            "vehicle_id": F.col("user_id"),
            "stop_sequence": F.col("secs"),
            "arr_time": F.when(F.col("event_id") % 5 != 0, F.col("ts")),
            "dep_time": F.when(F.col("event_id") % 7 != 0, F.col("ts") + F.expr("INTERVAL 30 SECONDS")),
        }
    )
    return shaping.arrivals_and_departures(r, others=["event_id"]).select("event_id", "stop_id", "stop_sequence", "event_type", "event_time")


@query(f"""{_E}, t AS (SELECT event_id, route_id, direction_id, stop_id, date_diff('day', DATE '2024-01-01', service_date) * 86400 + secs AS t FROM s)
SELECT event_id, (t - lag(t) OVER (PARTITION BY route_id, direction_id, stop_id ORDER BY t, event_id)) % 86400 AS scheduled_headway FROM t""")
def scheduled_headway_lag(spark, sf_dir):
    s = stop_records(spark, sf_dir).filter("is_scheduled").withColumn("at", F.datediff("service_date", F.lit("2024-01-01").cast("date")) * 86400 + F.col("secs"))
    return s.select("event_id", schedule.scheduled_headway(s, time="at", trip="event_id").alias("scheduled_headway"))


@query(f"""{_E}, t AS (SELECT event_id, user_id, date_diff('day', DATE '2024-01-01', service_date) * 86400 + secs AS t FROM s),
w AS (SELECT event_id, t - min(t) OVER (PARTITION BY user_id) AS since FROM t)
SELECT event_id, since % 86400 AS by_clock, since AS elapsed FROM w""")
def scheduled_travel_time(spark, sf_dir):
    s = stop_records(spark, sf_dir).filter("is_scheduled").withColumn("at", F.datediff("service_date", F.lit("2024-01-01").cast("date")) * 86400 + F.col("secs"))
    value = lambda by_clock: schedule.scheduled_travel_time(time="at", trip="user_id", by_clock=by_clock)
    return s.select("event_id", value(True).alias("by_clock"), value(False).alias("elapsed"))


@query(f"""{_E}, f AS (SELECT *, row_number() OVER (PARTITION BY service_date, trip_id ORDER BY ts, event_id) AS n FROM e)
SELECT trip_id, event_id, stop_id, secs FROM f WHERE n = 1""")
def trip_first_event(spark, sf_dir):
    return schedule.first_events(stop_records(spark, sf_dir), ["service_date", "trip_id"], "ts", ["event_id"]).select("trip_id", "event_id", "stop_id", "secs")


@query("""WITH f AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM f WHERE n = 1""")
def order_first_line(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate")
    return schedule.first_events(lines, ["l_orderkey"], "l_shipdate", ["l_linenumber", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _branch_sql(source: str, keys: str, order: str, route: str, stop: str) -> str:
    return f"""{source},
b AS (SELECT *, first_value({route}) OVER (PARTITION BY {keys} ORDER BY {order}) AS first_route,
             bool_or({stop} IN ('click', 'purchase')) OVER (PARTITION BY {keys}) AS a, bool_or({stop} IN ('error')) OVER (PARTITION BY {keys}) AS b FROM e)
SELECT event_id, CASE WHEN first_route <> 'R1' THEN first_route WHEN a AND NOT b THEN 'R1-A' WHEN b AND NOT a THEN 'R1-B' ELSE first_route END AS branch FROM b"""


@query(_branch_sql(_E, "service_date, trip_id", "ts, event_id", "route_id", "stop_id"))
def trip_branch(spark, sf_dir):
    branch = enrich.trip_branch(["service_date", "trip_id"], ["ts", "event_id"], branched="R1", branches={"R1-A": ["click", "purchase"], "R1-B": ["error"]})
    return stop_records(spark, sf_dir).select("event_id", branch.alias("branch"))


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_partkey % 10)::INT AS stop, 'B' || (l_orderkey % 3) AS route FROM lineitem),
w AS (SELECT *, bool_or(stop IN (1, 2)) OVER (PARTITION BY l_orderkey) AS a, bool_or(stop IN (3, 4)) OVER (PARTITION BY l_orderkey) AS b FROM x)
SELECT l_orderkey, CASE WHEN route <> 'B0' THEN route WHEN a AND NOT b THEN 'B0-A' WHEN b AND NOT a THEN 'B0-B' ELSE route END AS branch, count(*) AS n FROM w GROUP BY ALL""")
def order_branch(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 10).cast("int").alias("stop_id"), F.concat(F.lit("B"), (F.col("l_orderkey") % 3).cast("string")).alias("route_id"))
    branch = enrich.trip_branch(["l_orderkey"], ["l_linenumber"], branched="B0", branches={"B0-A": [1, 2], "B0-B": [3, 4]})
    return lines.select("l_orderkey", branch.alias("branch")).groupBy("l_orderkey", "branch").agg(F.count(F.lit(1)).alias("n"))


_MATCH = f"""{_E},
f AS (SELECT *, row_number() OVER (PARTITION BY service_date, trip_id ORDER BY ts, event_id) AS n FROM o),
c AS (SELECT o.service_date, o.trip_id, s.trip_id AS scheduled_trip_id,
             row_number() OVER (PARTITION BY o.service_date, o.trip_id ORDER BY {_NEAREST.replace("s.event_id", "s.k")}) AS n
      FROM (SELECT * FROM f WHERE n = 1) o LEFT JOIN (SELECT *, dense_rank() OVER (ORDER BY trip_id) AS k FROM s) s ON {_SAME}),
m AS (SELECT service_date, trip_id, scheduled_trip_id FROM c WHERE n = 1),
v AS (SELECT service_date, trip_id, stop_id, route_id, direction_id, secs, (secs - min(secs) OVER (PARTITION BY trip_id)) AS scheduled_tt FROM s),
x AS (SELECT o.event_id, o.service_date, o.route_id, o.direction_id, o.stop_id, o.secs, m.scheduled_trip_id, v.scheduled_tt
      FROM o LEFT JOIN m USING (service_date, trip_id)
      LEFT JOIN v ON v.service_date = o.service_date AND v.trip_id = m.scheduled_trip_id AND v.stop_id = o.stop_id)"""


def _scheduled(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    e = stop_records(spark, sf_dir)
    seen = e.filter("not is_scheduled")
    stops = e.filter("is_scheduled").withColumn("scheduled_tt", F.col("secs") - F.min("secs").over(Window.partitionBy("service_date", "trip_id")))
    return enrich.match_trips(seen, stops, _BY, "ts", "secs", ["event_id"]), stops


@query(f"{_MATCH} SELECT event_id, scheduled_trip_id, scheduled_tt FROM x")
def trip_match_lookup(spark, sf_dir):
    return _scheduled(spark, sf_dir)[0].select("event_id", "scheduled_trip_id", "scheduled_tt")


@query(f"""{_MATCH}, u AS (SELECT service_date, route_id, direction_id, stop_id, secs // 1800 AS bucket, median(scheduled_tt) AS usual FROM v GROUP BY ALL)
SELECT x.event_id, coalesce(x.scheduled_tt::DOUBLE, u.usual) AS scheduled_tt FROM x LEFT JOIN u
  ON u.service_date = x.service_date AND u.route_id = x.route_id AND u.direction_id = x.direction_id AND u.stop_id = x.stop_id AND u.bucket = x.secs // 1800""")
def fallback_bucket_median(spark, sf_dir):
    events, stops = _scheduled(spark, sf_dir)
    return enrich.fill_travel_time(events, stops, seconds="secs").select("event_id", "scheduled_tt")


@query(f"""{_E} SELECT event_id, round_even(avg(CASE WHEN event_id % 4 <> 0 THEN (event_id % 997)::DOUBLE END) OVER (PARTITION BY service_date, route_id, direction_id, stop_id, secs // 1800), -1)::DOUBLE AS headway FROM e""")
def headway_bucket_mean(spark, sf_dir):
    e = stop_records(spark, sf_dir).withColumn("event_time", F.to_utc_timestamp(F.col("ts").cast("timestamp"), "America/New_York")).withColumn("headway", F.when(F.col("event_id") % 4 != 0, (F.col("event_id") % 997).cast("double")))
    return enrich.smooth_headways(e, "headway").select("event_id", "headway")


@query("""WITH x AS (SELECT event_id, d, (d + INTERVAL 3 HOUR)::TIMESTAMP + to_seconds((event_id * 97) % 108000) AS utc
    FROM events, (VALUES (DATE '2024-03-10'), (DATE '2024-11-03'), (DATE '2024-07-04')) AS t(d)),
w AS (SELECT *, timezone('America/New_York', timezone('UTC', utc)) AS wall FROM x),
p AS (SELECT *, date_diff('day', d, wall::DATE) * 48 + CASE WHEN d = DATE '2024-11-03' AND utc >= TIMESTAMP '2024-11-03 06:00:00' AND utc < TIMESTAMP '2024-11-03 07:00:00' THEN 3
      ELSE hour(wall) * 2 + minute(wall) // 30 END AS b FROM w)
SELECT event_id, strftime(d, '%Y-%m-%d') AS service_date, CASE WHEN b BETWEEN 0 AND 96 THEN b END::INT AS bucket FROM p""")
def dst_bucket(spark, sf_dir):
    days = F.explode(F.array(*[F.lit(d).cast("date") for d in ("2024-03-10", "2024-11-03", "2024-07-04")])).alias("d")
    x = _table(spark, sf_dir, "events").select("event_id", days)
    instant = F.timestamp_seconds(F.unix_timestamp(F.col("d").cast("timestamp")) + 10800 + (F.col("event_id") * 97) % 108000)
    return x.select("event_id", F.col("d").cast("string").alias("service_date"), tu.clock_bucket(instant, F.col("d")).alias("bucket"))


_FEEDS = [("f1", "1995-01-01", "1996-06-30", 0), ("f2", "1996-06-01", "1998-12-31", 1), ("f0", "1996-01-01", "1996-12-31", 2), ("f3", "1999-02-01", "2001-12-31", 3)]
_FEED_SQL = "feeds(feed_id, start_d, end_d, position) AS (VALUES " + ", ".join(f"('{i}', DATE '{a}', DATE '{b}', {p})" for i, a, b, p in _FEEDS) + ")"


def _feeds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_FEEDS, "feed_id string, start string, end string, position long").withColumns({c: F.col(c).cast("date") for c in ("start", "end")})


@query(f"""WITH {_FEED_SQL}, d AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders),
m AS (SELECT d, arg_min(feed_id, position) AS feed_id FROM d JOIN feeds ON d BETWEEN start_d AND end_d GROUP BY d)
SELECT o_orderkey, feed_id FROM orders LEFT JOIN m ON m.d = o_orderdate::DATE""")
def feed_version_range_join(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("service_date"))
    dates = schedule.feed_of_dates(orders.select("service_date").distinct(), _feeds(spark))
    return orders.join(dates, "service_date", "left").select("o_orderkey", "feed_id")


_WEEK = "monday tuesday wednesday thursday friday saturday sunday".split()
_CALENDAR = [("f1", "week", 1, 1, 1, 1, 1, 0, 0, "1995-01-01", "1996-12-31"), ("f2", "week", 1, 1, 1, 1, 1, 0, 0, "1996-01-01", "1999-12-31"), ("f2", "sat", 0, 0, 0, 0, 0, 1, 0, "1996-01-01", "1999-12-31"), ("f3", "daily", 1, 1, 1, 1, 1, 1, 1, "1999-01-01", "2001-12-31"), ("f3", "sun", 0, 0, 0, 0, 0, 0, 1, "2000-01-01", "2000-12-31")]
_CHANGES = [("f1", "week", "1995-07-04", 2), ("f1", "extra", "1995-07-04", 1), ("f2", "week", "1997-12-25", 2), ("f2", "sat", "1997-12-25", 1), ("f3", "daily", "2000-01-01", 2), ("f3", "daily", "2000-01-01", 1)]
_SERVICES = f"""{_FEED_SQL}, d AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders),
m AS (SELECT d, arg_min(feed_id, position) AS feed_id FROM d JOIN feeds ON d BETWEEN start_d AND end_d GROUP BY d),
calendar(feed_id, service_id, {", ".join(_WEEK)}, a, b) AS (VALUES {", ".join(f"('{r[0]}', '{r[1]}', {', '.join(map(str, r[2:9]))}, DATE '{r[9]}', DATE '{r[10]}')" for r in _CALENDAR)}),
changes(feed_id, service_id, d, kind) AS (VALUES {", ".join(f"('{f}', '{s}', DATE '{d}', {k})" for f, s, d, k in _CHANGES)}),
services AS (
    (SELECT m.d, m.feed_id, service_id FROM m JOIN calendar c ON c.feed_id = m.feed_id AND m.d BETWEEN a AND b
       AND CASE dayname(m.d) {" ".join(f"WHEN '{w.capitalize()}' THEN {w}" for w in _WEEK)} END = 1
     EXCEPT SELECT m.d, m.feed_id, service_id FROM m JOIN changes c ON c.feed_id = m.feed_id AND c.d = m.d WHERE kind = 2)
    UNION SELECT m.d, m.feed_id, service_id FROM m JOIN changes c ON c.feed_id = m.feed_id AND c.d = m.d WHERE kind = 1)"""


def _services(spark, sf_dir) -> DataFrame:
    dates = schedule.feed_of_dates(_table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("service_date")).distinct(), _feeds(spark))
    calendar = spark.createDataFrame(_CALENDAR, ", ".join(["feed_id string", "service_id string", *[f"{w} int" for w in _WEEK], "start_date string", "end_date string"])).withColumns({c: F.col(c).cast("date") for c in ("start_date", "end_date")})
    changes = spark.createDataFrame(_CHANGES, "feed_id string, service_id string, date string, exception_type int").withColumn("date", F.col("date").cast("date"))
    return schedule.active_services(dates.filter("feed_id is not null"), calendar, changes)


@query(f"WITH {_SERVICES} SELECT strftime(d, '%Y-%m-%d') AS service_date, feed_id, service_id FROM services")
def active_services(spark, sf_dir):
    return _services(spark, sf_dir).select(F.col("service_date").cast("string").alias("service_date"), "feed_id", "service_id")


@query(f"""WITH {_SERVICES},
names AS (SELECT d, feed_id, sha256(feed_id || '|' || string_agg(service_id, '|' ORDER BY service_id)) AS variant FROM services GROUP BY d, feed_id),
sets AS (SELECT DISTINCT variant, s.feed_id, service_id FROM services s JOIN names n ON n.d = s.d AND n.feed_id = s.feed_id),
trips AS (SELECT 'f' || (o_orderkey % 3 + 1) AS feed_id, o_orderkey AS trip_id, 'R' || (o_custkey % 5) AS route_id, CASE WHEN o_orderkey % 2 = 0 THEN 'week' ELSE 'daily' END AS service_id, (o_custkey % 2)::INT AS direction_id FROM orders)
SELECT variant, route_id, direction_id, count(*) AS stops, sum(l_linenumber * 14410)::BIGINT AS seconds
FROM trips JOIN sets USING (feed_id, service_id) JOIN lineitem ON l_orderkey = trip_id GROUP BY ALL""")
def schedule_expansion(spark, sf_dir):
    trips = _table(spark, sf_dir, "orders").select(F.concat(F.lit("f"), (F.col("o_orderkey") % 3 + 1).cast("string")).alias("feed_id"), F.col("o_orderkey").alias("trip_id"), F.concat(F.lit("R"), (F.col("o_custkey") % 5).cast("string")).alias("route_id"), F.when(F.col("o_orderkey") % 2 == 0, "week").otherwise("daily").alias("service_id"), (F.col("o_custkey") % 2).alias("direction_id"))
    text = F.concat_ws(":", (F.col("l_linenumber") * 4).cast("string"), F.lit("00"), F.lpad((F.col("l_linenumber") * 10).cast("string"), 2, "0"))
    stop_times = _table(spark, sf_dir, "lineitem").select(F.concat(F.lit("f"), (F.col("l_orderkey") % 3 + 1).cast("string")).alias("feed_id"), F.col("l_orderkey").alias("trip_id"), F.col("l_suppkey").alias("stop_id"), text.alias("arrival_time"))
    _, stops = schedule.expand(_services(spark, sf_dir), trips, stop_times)
    return stops.groupBy("variant", "route_id", "direction_id").agg(F.count(F.lit(1)).alias("stops"), F.sum("arrival_time").alias("seconds"))


def _write_feeds(root: str, **tables: DataFrame) -> None:
    """Timetable tables as text below root/feed/name.txt."""
    for name, df in tables.items():
        for feed in [r[0] for r in df.select("feed_id").distinct().collect()]:
            df.filter(F.col("feed_id") == feed).drop("feed_id").write.option("header", True).csv(f"{root}/{feed}/{name}.txt")


def _write_index(spark: SparkSession, feeds: list[tuple], path: str) -> None:
    rows = [(a.replace("-", ""), b.replace("-", ""), f"https://feeds/{i}.zip") for i, a, b, _ in feeds]
    spark.createDataFrame(rows, "feed_start_date string, feed_end_date string, archive_url string").coalesce(1).write.option("header", True).csv(path)


@query(ORACLE_SQL["schedule_expansion"])
def schedule_from_files(spark, sf_dir):
    """The same from timetable files: feed index and the text tables of three feeds, written, read and expanded."""
    root = shared_dir(spark)
    orders, lines = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem")
    feed = lambda key: F.concat(F.lit("f"), (F.col(key) % 3 + 1).cast("string")).alias("feed_id")
    number = lambda c: F.date_format(F.col(c).cast("date"), "yyyyMMdd").alias(c)
    trips = orders.select(feed("o_orderkey"), F.concat(F.lit("R"), (F.col("o_custkey") % 5).cast("string")).alias("route_id"), F.when(F.col("o_orderkey") % 2 == 0, "week").otherwise("daily").alias("service_id"), F.col("o_orderkey").alias("trip_id"), (F.col("o_custkey") % 2).alias("direction_id"))
    text = F.concat_ws(":", (F.col("l_linenumber") * 4).cast("string"), F.lit("00"), F.lpad((F.col("l_linenumber") * 10).cast("string"), 2, "0"))
    stop_times = lines.select(feed("l_orderkey"), F.col("l_orderkey").alias("trip_id"), F.col("l_suppkey").alias("stop_id"), text.alias("arrival_time"), text.alias("departure_time"))
    calendar = spark.createDataFrame(_CALENDAR, ", ".join(["feed_id string", "service_id string", *[f"{w} int" for w in _WEEK], "start_date string", "end_date string"]))
    calendar = calendar.select("feed_id", "service_id", *_WEEK, number("start_date"), number("end_date"))
    changes = spark.createDataFrame(_CHANGES, "feed_id string, service_id string, date string, exception_type int").select("feed_id", "service_id", number("date"), "exception_type")
    _write_feeds(f"{root}/gtfs", trips=trips, stop_times=stop_times, calendar=calendar, calendar_dates=changes)
    _write_index(spark, _FEEDS, f"{root}/index")
    tables, feeds = readers.gtfs(spark, f"{root}/gtfs"), readers.feed_index(spark, f"{root}/index")
    dates = schedule.feed_of_dates(orders.select(F.col("o_orderdate").cast("date").alias("service_date")).distinct(), feeds)
    services = schedule.active_services(dates.filter("feed_id is not null"), tables["calendar"], tables["calendar_dates"])
    _, stops = schedule.expand(services, tables["trips"], tables["stop_times"])
    return stops.groupBy("variant", "route_id", "direction_id").agg(F.count(F.lit(1)).alias("stops"), F.sum("arrival_time").alias("seconds"))


_INGEST = _MATCH.replace("s AS (SELECT * FROM e WHERE is_scheduled)", "s AS (SELECT * FROM e WHERE is_scheduled AND trip_id IN (SELECT trip_id FROM o))").replace("o AS (SELECT * FROM e WHERE NOT is_scheduled)", "o AS (SELECT * FROM e WHERE NOT is_scheduled AND stop_id <> 'error')").replace("ORDER BY ts, event_id) AS n FROM o)", "ORDER BY date_trunc('second', ts), event_id % 1000, stop_id) AS n FROM o)")


def daily_files(spark: SparkSession, e: DataFrame, root: str) -> tuple[Callable[[object], str], str, str]:
    """Daily parquet of the observed records and a timetable of the scheduled ones below root: (path of a date, timetable, index). The dates of each month's second half hold direction_id as a boolean."""
    none = lambda c: F.lit(None).cast(S.DAILY_TYPES[c]).alias(c)
    have = {
        "service_date": F.date_format("service_date", "yyyyMMdd").cast("long"),
        "route_id": F.col("route_id"),
        "trip_id": F.col("trip_id"),
        "stop_id": F.nullif("stop_id", F.lit("error")),
        "direction_id": F.col("direction_id").cast("smallint"),
        "stop_sequence": (F.col("event_id") % 1000).cast("smallint"),
        "vehicle_id": F.lit("v"),
        "vehicle_label": F.col("event_id").cast("string"),
        "stop_timestamp": F.unix_timestamp(F.to_utc_timestamp(F.date_trunc("second", "ts").cast("timestamp"), S.ZONE)),
        "scheduled_headway_trunk": F.when(F.col("event_id") % 4 != 0, F.col("event_id") % 997),
    }
    records = e.filter("not is_scheduled").select(F.col("service_date").alias("d"), *[have[c].alias(c) if c in have else none(c) for c in S.DAILY_INPUT])
    for half, kind in ((F.dayofmonth("d") < 16, "smallint"), (F.dayofmonth("d") >= 16, "boolean")):
        some = records.filter(half).withColumn("direction_id", F.col("direction_id").cast(kind))
        some.repartition("d").write.mode("append").partitionBy("d").parquet(f"{root}/daily")
    stops = e.filter("is_scheduled")
    clock = F.concat_ws(":", F.floor(F.col("secs") / 3600).cast("string"), *[F.lpad(c.cast("string"), 2, "0") for c in (F.floor(F.col("secs") / 60) % 60, F.col("secs") % 60)])
    feed = F.lit("all").alias("feed_id")
    trips = stops.select(feed, "route_id", F.lit("s").alias("service_id"), "trip_id", "direction_id").distinct()
    _write_feeds(
        f"{root}/gtfs",
        trips=trips,
        stop_times=stops.select(feed, "trip_id", "stop_id", clock.alias("arrival_time"), clock.alias("departure_time")),
        calendar=stops.limit(1).select(feed, F.lit("s").alias("service_id"), *[F.lit(1).alias(w) for w in _WEEK], F.lit("19900101").alias("start_date"), F.lit("20991231").alias("end_date")),
        calendar_dates=stops.limit(1).select(feed, F.lit("t").alias("service_id"), F.lit("19900101").alias("date"), F.lit(2).alias("exception_type")),
    )
    _write_index(spark, [("all", "1990-01-01", "2099-12-31", 0)], f"{root}/index")
    return lambda d: f"{root}/daily/d={d}", f"{root}/gtfs", f"{root}/index"


@query(f"""{_INGEST}, u AS (SELECT service_date, route_id, direction_id, stop_id, secs // 1800 AS bucket, median(scheduled_tt) AS usual FROM v GROUP BY ALL)
SELECT x.event_id, x.stop_id, coalesce(x.scheduled_tt::DOUBLE, u.usual) AS scheduled_tt,
  round_even(avg(CASE WHEN x.event_id % 4 <> 0 THEN (x.event_id % 997)::DOUBLE END) OVER (PARTITION BY x.service_date, x.route_id, x.direction_id, x.stop_id, x.secs // 1800), -1)::DOUBLE AS scheduled_headway
FROM x LEFT JOIN u ON u.service_date = x.service_date AND u.route_id = x.route_id AND u.direction_id = x.direction_id AND u.stop_id = x.stop_id AND u.bucket = x.secs // 1800""")
def daily_ingest(spark, sf_dir):
    """Daily parquet of all dates, of two types of direction, and a timetable, ingested twice by the backfill of their range and read back from the sink."""
    root = shared_dir(spark)
    e = stop_records(spark, sf_dir)
    path_of, *feeds = daily_files(spark, e, root)
    first, last = e.filter("not is_scheduled").agg(F.min("service_date"), F.max("service_date")).first()
    for _ in range(2):  # a second run leaves the same
        refresh.backfill(spark, f"{root}/daily", *feeds, f"{root}/out", first, last, path_of=lambda _, d: path_of(d))
    back = spark.read.option("header", True).csv(f"{root}/out")
    return back.select(F.col("vehicle_label").cast("long").alias("event_id"), "stop_id", *[F.col(c).cast("double").alias(c) for c in ("scheduled_tt", "scheduled_headway")])


@query("""SELECT l.l_orderkey AS trip_id, l.l_suppkey AS stop_id, (l.l_linenumber * 600)::BIGINT AS arrival_time, 'R' || (o_custkey % 5) AS route_id, (o_custkey % 2)::INT AS direction_id
FROM lineitem l JOIN orders ON o_orderkey = l.l_orderkey WHERE o_orderkey IN (SELECT event_id FROM events)""")
def scheduled_stops_of_trips(spark, sf_dir):
    trips = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("trip_id"), F.concat(F.lit("R"), (F.col("o_custkey") % 5).cast("string")).alias("route_id"), (F.col("o_custkey") % 2).cast("int").alias("direction_id"))
    stop_times = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("trip_id"), F.col("l_suppkey").alias("stop_id"), (F.col("l_linenumber") * 600).cast("long").alias("arrival_time"))
    wanted = _table(spark, sf_dir, "events").select(F.col("event_id").alias("trip_id"))
    return readers.scheduled_stops(stop_times, trips, wanted).select("trip_id", "stop_id", "arrival_time", "route_id", "direction_id")


def historic_sql(keep: str) -> str:
    """The observed events for which `keep` holds, matched to the day's scheduled ones."""
    match = _MATCH.replace("ORDER BY ts, event_id) AS n FROM o", "ORDER BY date_trunc('second', ts), stop_id, event_id) AS n FROM o").replace("WHERE NOT is_scheduled", f"WHERE NOT is_scheduled AND {keep}")
    return f"""{match},
h AS (SELECT service_date, route_id, direction_id, stop_id, secs, trip_id, (secs - lag(secs) OVER (PARTITION BY service_date, route_id, direction_id, stop_id ORDER BY secs, trip_id)) % 86400 AS headway FROM s),
b AS (SELECT o.event_id, s.headway, row_number() OVER (PARTITION BY o.event_id ORDER BY s.secs DESC, s.trip_id DESC) AS n FROM o LEFT JOIN h s ON {_SAME} AND s.secs <= o.secs),
y AS (SELECT o.event_id, m.scheduled_trip_id, v.scheduled_tt FROM o LEFT JOIN m USING (service_date, trip_id)
      LEFT JOIN v ON v.service_date = o.service_date AND v.trip_id = m.scheduled_trip_id AND v.stop_id = o.stop_id AND v.route_id = o.route_id AND v.direction_id = o.direction_id)
SELECT y.event_id, b.headway AS scheduled_headway, y.scheduled_trip_id, y.scheduled_tt FROM y JOIN b ON b.event_id = y.event_id AND b.n = 1"""


@query(historic_sql("true"))
def historic_enrichment(spark, sf_dir):
    e = stop_records(spark, sf_dir)
    events = e.filter("not is_scheduled").withColumn("event_time", F.date_trunc("second", "ts").cast("timestamp_ntz"))
    days = e.select("service_date", F.col("service_date").cast("string").alias("variant")).distinct()
    stops = e.filter("is_scheduled").select(F.col("service_date").cast("string").alias("variant"), "trip_id", "stop_id", F.col("secs").alias("arrival_time"), "route_id", "direction_id")
    out = schedule.add_schedule(events, days, stops)
    return out.select("event_id", "scheduled_headway", "scheduled_trip_id", "scheduled_tt")


@query("""SELECT o_orderkey, o_orderstatus || '-' || o_orderkey AS trip_id FROM orders WHERE NOT (starts_with(o_orderstatus || '-', 'P-') AND o_orderdate::DATE < DATE '1998-11-30')""")
def nonrev_filter(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws("-", "o_orderstatus", F.col("o_orderkey").cast("string")).alias("trip_id"), F.col("o_orderdate").cast("date").alias("service_date"))
    return shaping.drop_non_revenue(o, prefix="P-", cutoff="1998-11-30").select("o_orderkey", "trip_id")


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN '70061' WHEN 'MACHINERY' THEN '70001' ELSE c_mktsegment END AS stop_id FROM customer")
def stop_alias(spark, sf_dir):
    return _table(spark, sf_dir, "customer").select("c_custkey", shaping.map_values(F.col("c_mktsegment"), {"BUILDING": "70061", "MACHINERY": "70001"}).alias("stop_id"))


@query(f"{_E}, {_RECORDS} SELECT event_id, nullif(stop_id, 'error') AS stop_id FROM r WHERE nullif(stop_id, 'error') IS NOT NULL")
def null_stop_filter(spark, sf_dir):
    return shaping.with_stop(stop_records(spark, sf_dir).select("event_id", F.nullif("stop_id", F.lit("error")).alias("stop_id")))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 END AS direction_id FROM orders")
def direction_map(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select("o_orderkey", shaping.map_values(F.col("o_orderstatus"), {"O": 0, "F": 1}, keep_others=False).alias("direction_id"))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1996-02-28' AND DATE '1997-03-01'")
def date_range_filter(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("service_date"))
    return shaping.in_date_range(o, start="1996-02-28", end="1997-03-01").select("o_orderkey")


@query("SELECT p_partkey, ltrim(lpad((p_size)::VARCHAR, 3, '0'), '0') AS route_id FROM part WHERE ltrim(lpad((p_size)::VARCHAR, 3, '0'), '0') IN ('1', '28', '39', '7')")
def route_allow_list(spark, sf_dir):
    p = _table(spark, sf_dir, "part").select("p_partkey", F.lpad(F.col("p_size").cast("string"), 3, "0").alias("route_id"))
    return shaping.only_routes(p, ["1", "28", "39", "7"])


@query("SELECT event_id FROM events WHERE event_id % 3 <> 0 AND event_id % 5 <> 0")
def dropna_subset(spark, sf_dir):
    e = _table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 3 != 0, 1).alias("a"), F.when(F.col("event_id") % 5 != 0, 1).alias("b"), F.lit(None).cast("int").alias("c"))
    return e.dropna(subset=["a", "b"]).select("event_id")


@query("SELECT o_orderkey AS trip_id, o_custkey AS vehicle_id, (o_orderkey % 2)::SMALLINT AS direction_id, o_totalprice AS headway_seconds FROM orders")
def rename_project(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").withColumnsRenamed({"o_orderkey": "trip_id", "o_custkey": "vehicle_id", "o_totalprice": "headway_seconds", "absent": "gone"})
    return o.withColumn("direction_id", (F.col("trip_id") % 2 == 1).cast("smallint")).select("trip_id", "vehicle_id", "direction_id", "headway_seconds")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, NULL::VARCHAR AS vehicle_consist, '' AS vehicle_label FROM orders")
def drop_add_columns(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").drop("o_totalprice", "o_orderdate", "o_orderpriority", "absent")
    return o.withColumns({"vehicle_consist": F.lit(None).cast("string"), "vehicle_label": F.lit("")})


@query("""SELECT l_orderkey, l_linenumber, 'ARR' AS event_type, l_partkey AS stop_id, strftime(l_shipdate, '%Y-%m-%d') AS event_time FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'DEP', l_suppkey, strftime(l_shipdate + INTERVAL 1 DAY, '%Y-%m-%d') FROM lineitem""")
def field_mapping_split(spark, sf_dir):
    side = lambda kind, stop, days: F.struct(F.lit(kind).alias("event_type"), F.col(stop).alias("stop_id"), F.date_format(F.date_add("l_shipdate", days), "yyyy-MM-dd").alias("event_time"))
    both = F.explode(F.array(side("ARR", "l_partkey", 0), side("DEP", "l_suppkey", 1))).alias("e")
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", both).select("l_orderkey", "l_linenumber", "e.*")


@query("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 7 <> 0 THEN c_name END, sha256(c_nationkey || '|' || c_mktsegment || '|' || c_custkey)) AS trip_id FROM customer")
def missing_id_fill(spark, sf_dir):
    c = _table(spark, sf_dir, "customer").withColumn("trip_id", F.when(F.col("c_custkey") % 7 != 0, F.col("c_name")))
    return shaping.fill_trip_id(c, ["c_nationkey", "c_mktsegment", "c_custkey"]).select("c_custkey", "trip_id")


@query("""WITH x AS (SELECT event_id, 'file' || (event_id % 4) AS f, (DATE '2024-04-01' + ((event_id % 4) * 40 + event_id % 20)::INT) AS d, 1 + event_id % 2 AS day, ts FROM events),
y AS (SELECT *, min(d) OVER (PARTITION BY f) >= DATE '2024-06-01' AS utc,
     d::TIMESTAMP + to_days((day - 1)::INT) + to_hours(hour(ts)) + to_minutes(minute(ts)) + to_seconds(second(ts)) AS t FROM x)
SELECT event_id, strftime(CASE WHEN utc THEN timezone('America/New_York', timezone('UTC', t)) ELSE t END, '%Y-%m-%d %H:%M:%S') AS actual, (event_id % 3 = 0)::INT AS direction_id FROM y""")
def bus_time_repair(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    placeholder = F.concat(F.lit("1900-01-0"), (1 + F.col("event_id") % 2).cast("string"), F.date_format(F.col("ts").cast("timestamp"), "'T'HH:mm:ss'Z'"))
    rows = e.select(
        "event_id",
        F.concat(F.lit("file"), (F.col("event_id") % 4).cast("string")).alias("source_file"),
        F.date_add(F.lit("2024-04-01").cast("date"), ((F.col("event_id") % 4) * 40 + F.col("event_id") % 20).cast("int")).cast("string").alias("service_date"),
        F.lit("01").alias("route_id"),
        F.lit("1").alias("stop_id"),
        placeholder.alias("scheduled"),
        placeholder.alias("actual"),
        F.when(F.col("event_id") % 3 == 0, "Inbound").otherwise("Outbound").alias("direction_id"),
    )
    out = shaping.clean_bus(rows, ["1"], "source_file")
    return out.select("event_id", F.date_format(F.col("actual").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("actual"), "direction_id")


@query("""SELECT l_orderkey AS trip_id, l_linenumber AS stop_sequence, CASE l_returnflag WHEN 'R' THEN 'DEP' WHEN 'N' THEN 'ARR' END AS event_type, l_partkey AS stop_id FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'DEP', l_partkey FROM lineitem WHERE l_returnflag = 'N'""")
def bus_event_explode(spark, sf_dir):
    point = F.when(F.col("l_returnflag") == "R", "Startpoint").when(F.col("l_returnflag") == "N", "Midpoint").otherwise(F.col("l_returnflag"))
    rows = _table(spark, sf_dir, "lineitem").select(F.lit("2020-01-15").alias("service_date"), F.lit("1").alias("route_id"), F.col("l_orderkey").alias("trip_id"), F.lit(0).alias("direction_id"), F.col("l_partkey").alias("stop_id"), F.col("l_linenumber").alias("stop_sequence"), F.col("l_shipdate").alias("event_time"), F.lit(None).cast("int").alias("scheduled_headway"), F.lit(None).cast("int").alias("scheduled_tt"), point.alias("point_type"))
    return shaping.bus_events(rows).select("trip_id", "stop_sequence", "event_type", "stop_id")


@query("""WITH f AS (SELECT event_id, ts, CASE event_id % 3 WHEN 0 THEN 'Boat-F1' WHEN 1 THEN 'Boat-F4' ELSE 'X9' END AS route, (event_id % 2)::INT AS direction,
    timezone('America/New_York', timezone('UTC', date_trunc('second', ts)))::DATE AS d FROM events WHERE event_id % 11 <> 0)
SELECT event_id, strftime(d, '%Y-%m-%d') AS service_date, route AS route_id, direction AS direction_id, stop_id, event_type, strftime(date_trunc('second', ts) + shift, '%Y-%m-%d %H:%M:%S') AS event_time
FROM f, (VALUES ('Boat-Hull', 'ARR', INTERVAL 20 MINUTE), ('Boat-Long', 'DEP', INTERVAL 0 MINUTE)) AS t(stop_id, event_type, shift) WHERE d >= DATE '2024-01-03'""")
def ferry_service_date(spark, sf_dir):
    ts = F.date_trunc("second", F.col("ts").cast("timestamp"))
    text = lambda c, zone="": F.date_format(c, f"yyyy-MM-dd HH:mm:ss'{zone}'" if zone else "yyyy-MM-dd HH:mm:ss")
    rows = _table(spark, sf_dir, "events").select(
        text(ts, "+00:00").alias("service_date"),
        F.element_at(F.array(F.lit("F1"), F.lit("F4"), F.lit("X9")), (F.col("event_id") % 3 + 1).cast("int")).alias("route_id"),
        F.col("event_id").cast("string").alias("trip_id"),
        F.when(F.col("event_id") % 2 == 1, "To Boston").otherwise("From Boston").alias("travel_direction"),
        F.when(F.col("event_id") % 11 != 0, "Boston").alias("departure_terminal"),
        F.lit("HULL").alias("arrival_terminal"),
        text(ts, "+00:00").alias("mbta_sched_arrival"),
        text(ts, "+00:00").alias("mbta_sched_departure"),
        text(ts).alias("actual_departure"),
        text(ts + F.expr("INTERVAL 20 MINUTES")).alias("actual_arrival"),
        F.lit("slot").alias("vessel_time_slot"),
    )
    out = shaping.ferry_events(rows, start="2024-01-03")
    return out.select(F.col("trip_id").cast("long").alias("event_id"), F.col("service_date").cast("string").alias("service_date"), "route_id", "direction_id", "stop_id", "event_type", F.date_format(F.col("event_time").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("event_time"))


@query("SELECT event_id, strftime((ts - INTERVAL 3 HOUR)::DATE, '%Y-%m-%d') AS service_date FROM events")
def service_date(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", tu.service_date(F.col("ts")).cast("string").alias("service_date"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d')::INT AS dateint, strftime(o_orderdate, '%Y-%m-%d') AS text, lower(dayname(o_orderdate)) AS weekday FROM orders")
def dateint(spark, sf_dir):
    n = tu.date_int(F.col("o_orderdate"))
    return _table(spark, sf_dir, "orders").select("o_orderkey", n.alias("dateint"), tu.to_date_from_int(n).cast("string").alias("text"), tu.weekday(F.col("o_orderdate")).alias("weekday"))


@query("SELECT event_id, ((event_id % 30) * 3600 + event_id % 60 * 60 + event_id % 59)::INT AS seconds FROM events")
def gtfs_time_seconds(spark, sf_dir):
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    i = F.col("event_id")
    return _table(spark, sf_dir, "events").select("event_id", tu.seconds_of_time(F.concat_ws(":", pad(i % 30), pad(i % 60), pad(i % 59))).alias("seconds"))


@query("""SELECT strftime(d, '%Y-%m-%d') AS date, count(o_orderkey) AS n FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH))::DATE AS d FROM orders) m
LEFT JOIN orders ON date_trunc('month', o_orderdate)::DATE = d GROUP BY d""")
def calendar_ranges(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", F.trunc("o_orderdate", "month").alias("date"))
    ends = orders.agg(F.min("date"), F.max("date")).first()
    months = tu.date_range(spark, str(ends[0]), str(ends[1]), months=True)
    return months.join(orders, "date", "left").groupBy(F.col("date").cast("string").alias("date")).agg(F.count("o_orderkey").alias("n"))


_NET = f"""{_E},
g AS (SELECT 'C' || (user_id % 2) AS color, lag(stop_id) OVER w AS from_stop, stop_id AS to_stop, service_date, secs - lag(secs) OVER w AS gap FROM e WINDOW w AS (PARTITION BY user_id, service_date ORDER BY ts, event_id)),
seg AS (SELECT color, from_stop, to_stop, service_date, median(gap)::DOUBLE AS p50 FROM g WHERE from_stop IS NOT NULL AND from_stop <> to_stop GROUP BY ALL),
dw AS (SELECT 'C' || (user_id % 2) AS color, stop_id AS from_stop, service_date, median(event_id % 300)::DOUBLE AS p50 FROM e WHERE stop_id IN ('click', 'view', 'error') GROUP BY ALL),
edge AS (SELECT DISTINCT color, from_stop, to_stop FROM seg)"""
_NET_PATHS = _NET.replace("WITH e AS", "WITH RECURSIVE e AS") + """,
p(color, path) AS (SELECT color, [from_stop, to_stop] FROM edge
    UNION ALL SELECT p.color, list_append(p.path, edge.to_stop) FROM p JOIN edge ON edge.color = p.color AND edge.from_stop = p.path[-1] WHERE NOT list_contains(p.path, edge.to_stop))"""
_NET_SUMS = f"""{_NET_PATHS},
part AS (SELECT color, path, 's|' || path[i] || '|' || path[i + 1] AS part FROM p, LATERAL (SELECT unnest(range(1, len(path))) AS i)
    UNION ALL SELECT color, path, 'd|' || path[i] FROM p, LATERAL (SELECT unnest(range(2, len(path))) AS i) WHERE EXISTS (SELECT 1 FROM dw WHERE dw.color = p.color AND dw.from_stop = path[i])),
fact AS (SELECT color, 's|' || from_stop || '|' || to_stop AS part, service_date, p50 FROM seg UNION ALL SELECT color, 'd|' || from_stop, service_date, p50 FROM dw),
need AS (SELECT color, path, count(*) AS n FROM part GROUP BY ALL),
sums AS (SELECT color, path, service_date, sum(p50) AS value, count(*) AS k FROM part JOIN fact USING (color, part) GROUP BY ALL),
daily AS (SELECT color, path, service_date, value FROM sums JOIN need USING (color, path) WHERE k = n)"""
_NET_PAIRS = f"""{_NET_SUMS},
mid AS (SELECT color, path, median(value) AS m FROM daily GROUP BY ALL HAVING count(*) >= 20 AND median(value) > 0),
pair AS (SELECT color, path[1] AS from_stop, path[-1] AS to_stop, min((ceil(m / 30) * 30)::INT) AS seconds FROM mid GROUP BY ALL)"""


def _network(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    e = stop_records(spark, sf_dir).withColumn("color", F.concat(F.lit("C"), (F.col("user_id") % 2).cast("string")))
    w = Window.partitionBy("user_id", "service_date").orderBy("ts", "event_id")
    g = e.select("color", F.lag("stop_id").over(w).alias("from_stop"), F.col("stop_id").alias("to_stop"), "service_date", (F.col("secs") - F.lag("secs").over(w)).alias("gap"))
    segments = g.filter("from_stop is not null and from_stop <> to_stop").groupBy("color", "from_stop", "to_stop", "service_date").agg(F.median("gap").alias("p50"))
    dwells = e.filter(F.col("stop_id").isin("click", "view", "error")).groupBy("color", F.col("stop_id").alias("from_stop"), "service_date").agg(F.median(F.col("event_id") % 300).alias("p50"))
    return segments, dwells


@query(f"{_NET} SELECT color, from_stop, to_stop FROM edge")
def edges(spark, sf_dir):
    return paths.edges(_network(spark, sf_dir)[0])


@query(f"{_NET_PATHS} SELECT color, array_to_string(path, '>') AS path FROM p")
def simple_paths(spark, sf_dir):
    return paths.simple_paths(paths.edges(_network(spark, sf_dir)[0])).select("color", F.array_join("path", ">").alias("path"))


@query(f"{_NET_SUMS} SELECT color, array_to_string(path, '>') AS path, strftime(service_date, '%Y-%m-%d') AS service_date, value FROM daily")
def path_daily_sum(spark, sf_dir):
    segments, dwells = (materialize(x) for x in _network(spark, sf_dir))
    out = paths.daily_path_values(paths.simple_paths(paths.edges(segments)), segments, dwells)
    return out.select("color", F.array_join("path", ">").alias("path"), F.col("service_date").cast("string").alias("service_date"), "value")


@query(f"{_NET_PAIRS} SELECT color, from_stop, to_stop, seconds FROM pair")
def pair_benchmark(spark, sf_dir):
    segments, dwells = (materialize(x) for x in _network(spark, sf_dir))
    return jobs.benchmarks(segments, dwells, min_days=20)


@query(f"""{_NET_PAIRS} SELECT color, '{{"color":"' || color || '","benchmarks":{{' || string_agg('"' || from_stop || '|' || to_stop || '":' || seconds, ',' ORDER BY from_stop || '|' || to_stop) || '}}}}' AS document FROM pair GROUP BY color""")
def benchmark_json(spark, sf_dir):
    segments, dwells = (materialize(x) for x in _network(spark, sf_dir))
    return paths.benchmark_documents(jobs.benchmarks(segments, dwells, min_days=20))


@query("SELECT l_orderkey, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY l_orderkey")
def dedupe_first(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return schedule.first_events(lines, ["l_orderkey"], "l_linenumber", []).select("l_orderkey", "l_linenumber")


@query(f"{_E} SELECT DISTINCT service_date::VARCHAR AS service_date, trip_id FROM e")
def distinct_trips(spark, sf_dir):
    return stop_records(spark, sf_dir).select(F.col("service_date").cast("string").alias("service_date"), "trip_id").distinct()


def _sink_events(spark, sf_dir) -> DataFrame:
    return stop_records(spark, sf_dir).select("event_id", "route_id", "direction_id", F.nullif("stop_id", F.lit("error")).alias("stop_id"), "service_date", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("event_time"))


_SINK = f"{_E} SELECT event_id, stop_id, service_date::VARCHAR AS service_date, year(service_date)::INT AS \"Year\", month(service_date)::INT AS \"Month\""


@query(f'{_SINK}, day(service_date)::INT AS "Day" FROM e WHERE stop_id <> \'error\'')
def sink_daily_roundtrip(spark, sf_dir):
    out = writers.round_trip(_sink_events(spark, sf_dir), writers.write_daily)
    return out.select(F.col("event_id").cast("long").alias("event_id"), F.col("stop").alias("stop_id"), F.col("service_date").cast("string").alias("service_date"), "Year", "Month", "Day")


@query(f"{_SINK} FROM e WHERE stop_id <> 'error'")
def sink_monthly_roundtrip(spark, sf_dir):
    out = writers.round_trip(_sink_events(spark, sf_dir), writers.write_monthly)
    return out.select(F.col("event_id").cast("long").alias("event_id"), F.col("stop").alias("stop_id"), F.col("service_date").cast("string").alias("service_date"), "Year", "Month")


@query(f"{_E} SELECT event_id, route_id || '|' || direction_id || '|' || stop_id AS key FROM e WHERE stop_id <> 'error'")
def sink_ferry_roundtrip(spark, sf_dir):
    return writers.round_trip(_sink_events(spark, sf_dir), writers.write_ferry).select(F.col("event_id").cast("long").alias("event_id"), "key")


@query(f"{_E} SELECT event_id, route_id || '-' || direction_id || '-' || stop_id AS key, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time FROM e WHERE stop_id <> 'error'")
def sink_bus_roundtrip(spark, sf_dir):
    out = writers.round_trip(_sink_events(spark, sf_dir), writers.write_bus)
    return out.select(F.col("event_id").cast("long").alias("event_id"), "key", F.col("event_time").cast("string").alias("event_time"))


@query(f"""{_E} SELECT event_id, stop_id, CASE WHEN day(service_date) % 2 = 0 THEN 'second' ELSE 'first' END AS run FROM e WHERE stop_id <> 'error'""")
def reingest_overwrite(spark, sf_dir):
    """All dates once, then every second date again: the second run's rows stand, other dates stay."""
    path = shared_dir(spark)
    events = _sink_events(spark, sf_dir)
    writers.write_daily(events.withColumn("run", F.lit("first")), path)
    writers.write_daily(events.filter(F.dayofmonth("service_date") % 2 == 0).withColumn("run", F.lit("second")), path)
    back = spark.read.option("header", True).csv(path)
    return back.select(F.col("event_id").cast("long").alias("event_id"), F.col("stop").alias("stop_id"), "run")


@query("SELECT year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, count(*) AS n, sum(o_custkey)::BIGINT AS custkeys FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1996-01-15' AND DATE '1999-06-15' GROUP BY ALL")
def backfill_range(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").withColumn("service_date", F.col("o_orderdate").cast("date"))
    kept = shaping.in_date_range(o, start="1996-01-15", end="1999-06-15")
    return kept.groupBy(F.year("service_date").alias("year"), F.month("service_date").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("custkeys"))


@query("SELECT o_orderkey AS half_trip_id, o_custkey AS stop_id, CASE WHEN o_orderkey % 2 = 0 THEN 'Inbound' ELSE 'Outbound' END AS direction_id, 1 + o_orderkey % 9 AS time_point_order FROM orders")
def source_csv_eras(spark, sf_dir):
    """Orders written as bus files of two header eras and read back under one set of names."""
    path = shared_dir(spark)
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 2 == 0, "Inbound").otherwise("Outbound").alias("d"), (1 + F.col("o_orderkey") % 9).alias("p"))
    for era, names, part in (("old", ("HalfTripId", "Stop", "Direction", "TimepointOrder"), 0), ("new", ("half_trip_id", "stop_id", "direction", "time_point_order"), 1)):
        o.filter(F.col("o_orderkey") % 3 % 2 == part).select(*[F.col(c).alias(n) for c, n in zip(o.columns, names, strict=True)]).write.option("header", True).csv(f"{path}/{era}")
    out = readers.bus_rows(spark, [f"{path}/old/*.csv", f"{path}/new/*.csv"])
    return out.select(F.col("half_trip_id").cast("long").alias("half_trip_id"), F.col("stop_id").cast("long").alias("stop_id"), "direction_id", F.col("time_point_order").cast("long").alias("time_point_order"))


@query(f"{_NET} SELECT color, from_stop, to_stop, strftime(service_date, '%Y-%m-%d') AS service_date, p50 FROM seg")
def source_filename_key(spark, sf_dir):
    """Percentiles written below folders named color/from_to and read back with the pair from the path."""
    path = shared_dir(spark)
    segments, _ = _network(spark, sf_dir)
    segments.select("color", F.concat_ws("_", "from_stop", "to_stop").alias("pair"), "service_date", F.col("p50").alias("50%")).repartition("color", "pair").write.partitionBy("color", "pair").option("header", True).option("compression", "gzip").csv(path)
    out = readers.pair_percentiles(spark, path, r"color=([^/]+)/pair=([^_/]+)_([^/]+)/[^/]+$")
    return out.select("color", "from_stop", "to_stop", F.col("service_date").cast("string").alias("service_date"), "p50")


@query(f"""{_E}, x AS (SELECT event_id, service_date, secs, date_diff('day', DATE '2024-01-01', service_date) AS n FROM e)
SELECT event_id, strftime(service_date::TIMESTAMP + to_seconds(secs + 7200), '%Y-%m-%d %H:%M:%S') AS event_time, (event_id % 50)::INT AS stop_sequence FROM x WHERE service_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""")
def subway_shape(spark, sf_dir):
    rows = stop_records(spark, sf_dir).select("event_id", "service_date", (F.col("secs") + 7200).alias("event_time_sec"), (F.col("event_id") % 50).cast("int").alias("sync_stop_sequence"))
    out = shaping.shape_subway(rows, "2024-01-05", "2024-01-25")
    return out.select("event_id", F.date_format(F.col("event_time").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("event_time"), "stop_sequence")
