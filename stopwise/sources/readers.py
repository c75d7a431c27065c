"""Scans of the inputs: daily parquet, monthly and yearly CSV, timetable text tables, percentile files.

CSV columns are chosen by header name and cast with try_cast, so a bad value is a null and not an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from csv import reader as csv_lines
from functools import reduce
from itertools import chain, islice

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import timeutil as tu
from ..functions.joins import join_checked
from ..functions.storage import shared_dir


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Columns by name, cast; a missing one is an error."""
    return df.select(*[F.col(f"`{c}`").try_cast(t).alias(c) if df.schema[c].dataType.simpleString() != t else F.col(f"`{c}`") for c, t in types.items()])


def csv(spark: SparkSession, paths: str | Sequence[str], recursive: bool = False, glob: str | None = None) -> DataFrame:
    """All columns as text, by header (a byte order mark is skipped). One header per call: files of other eras go in another call."""
    reader = spark.read.option("header", True).option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def heads(spark: SparkSession, paths: str | Sequence[str], at_once: int = 100) -> DataFrame:
    """The first line that isn't blank of each file, as a written table (file, header). Of a file no more than its beginning is read, which a limit for each file ensures; many files go in one job."""
    own = spark.newSession()  # a split for each whole file (the cost of opening bounds splits, too), without touching the settings of the caller's session
    for size in ("maxPartitionBytes", "openCostInBytes"):
        own.conf.set(f"spark.sql.files.{size}", str(1 << 50))
    files = own.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths)).select("path", F.col("_metadata.file_path").alias("file"))
    path = shared_dir(spark)
    spark.createDataFrame([], "file string, header string").write.parquet(path)
    names = files.toLocalIterator()
    while some := list(islice(names, at_once)):
        # a limit may take a row of any split; the header is in the first one
        first = [own.read.text(r.path).filter("trim(value) <> '' and _metadata.file_block_start = 0").limit(1).select(F.lit(r.file).alias("file"), F.col("value").alias("header")) for r in some]
        reduce(DataFrame.unionByName, first).write.mode("append").parquet(path)
    return spark.read.schema("file string, header string").parquet(path)


def csv_by_header(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All rows of files with different headers, matched by column name, with the file of each row as source_file.

    One scan takes all files by position; a table of files and headers tells which position a column has. What comes
    to the driver is the distinct headers.
    """
    table = heads(spark, paths)
    kinds = [r[0] for r in table.select("header").distinct().collect()]
    names = {h: [c.strip() for c in next(csv_lines([h.lstrip("\ufeff")]))] for h in sorted(kinds)}
    if not names:
        return spark.createDataFrame([], "source_file string")
    width = max(map(len, names.values()))
    rows = spark.read.schema(", ".join(f"_c{i} string" for i in range(width))).option("header", True).csv(paths if isinstance(paths, str) else list(paths))
    rows = rows.select("*", F.col("_metadata.file_path").alias("source_file"))
    if len(names) > 1:
        number = F.create_map(*chain.from_iterable((F.lit(h), F.lit(i)) for i, h in enumerate(names)))[F.col("header")]
        rows = join_checked(rows, table.select(F.col("file").alias("source_file"), number.alias("__kind")), ["source_file"])
    out = []
    spelled = {c.lower(): c for c in reversed([*chain.from_iterable(names.values())])}  # names that differ by case are one, as Spark has them
    for key, c in reversed(spelled.items()):
        at = [(i, [x.lower() for x in cols].index(key)) for i, cols in enumerate(names.values()) if key in map(str.lower, cols)]
        places = {p for _, p in at}
        if len(at) == len(names) and len(places) == 1:
            out.append(F.col(f"_c{places.pop()}").alias(c))
        else:
            out.append(F.coalesce(*[F.when(F.col("__kind") == i, F.col(f"_c{p}")) for i, p in at]).alias(c))
    return rows.select(*out, "source_file")


def by_schema(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> list[list[str]]:
    """Paths of parquet in groups whose files agree on the types of the columns.

    Footers are read by Spark's schema merge, many at a time; where that fails the paths are halved, so few odd files cost few more jobs.
    A path whose own files differ gives way to its files.
    """
    groups: dict[str, list[str]] = {}

    def add(some: list[str]) -> None:
        try:
            schema = spark.read.option("mergeSchema", True).parquet(*some).schema
        except (PySparkException, Py4JJavaError) as e:
            if "CANNOT_MERGE_SCHEMAS" not in str(e):
                raise
            if len(some) == 1:
                files = [r[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(some[0]).select("path").toLocalIterator() if r[0].endswith(".parquet")]
                if len(files) < 2:
                    raise
                some = sorted(files)
            add(some[: len(some) // 2])
            add(some[len(some) // 2 :])
        else:
            groups.setdefault(str([schema[c].dataType if c in schema.names else None for c in columns]), []).extend(some)

    add(list(paths))
    return list(groups.values())


def daily_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Daily stop records of any number of dates: the used columns only, nullable types. Files may hold direction_id as a boolean or as a number: a scan for each kind."""
    out = None
    for some in by_schema(spark, [paths] if isinstance(paths, str) else paths, S.DAILY_INPUT):
        df = spark.read.parquet(*some).select(*S.DAILY_INPUT)
        df = df.select(*[F.col(c).cast(S.DAILY_TYPES[c]).alias(c) for c in S.DAILY_INPUT])
        out = df if out is None else out.unionByName(df)
    return out


def daily_path(root: str, date: str, suffix: str = "subway-on-time-performance-v1.parquet") -> str:
    return f"{root.rstrip('/')}/{date}-{suffix}"


def subway_month(spark: SparkSession, paths: str | Sequence[str], from_2024: bool) -> DataFrame:
    """Monthly subway rows; files from 2024 on name their sequence otherwise."""
    sequence = "sync_stop_sequence" if from_2024 else "stop_sequence"
    kinds = {c: "string" for c in S.SUBWAY_INPUT} | {"service_date": "date", "direction_id": "int", "event_time_sec": "bigint"}
    cols = S.SUBWAY_INPUT_2024 if from_2024 else S.SUBWAY_INPUT
    return typed(csv(spark, paths), {c: "int" if c == sequence else kinds[c] for c in cols})


def bus_rows(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Bus rows of all eras under one set of names, with the file that each came from."""
    df = csv_by_header(spark, paths)
    # a column that several eras name in their own way is filled from whichever a file has
    names: dict[str, list[str]] = {}
    for c in df.columns:
        names.setdefault(S.BUS_RENAMES.get(c, c), []).append(c)
    df = df.select(*[F.coalesce(*[F.col(f"`{c}`") for c in old]).alias(new) for new, old in names.items()])
    return df.withColumn("time_point_order", F.col("time_point_order").try_cast("int"))


def ferry_rows(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return csv(spark, paths)


def gtfs_table(spark: SparkSession, root: str, name: str, types: Mapping[str, str]) -> DataFrame:
    """A timetable table of all feeds below root (root/feed/name.txt), with feed_id from the folder."""
    df = csv_by_header(spark, f"{root.rstrip('/')}/*/{name}.txt")
    cell = lambda c, t: (F.col(f"`{c}`") if c in df.columns else F.lit(None)).try_cast(t).alias(c)
    return df.select(*[cell(c, t) for c, t in types.items()], F.regexp_extract("source_file", rf"([^/]+)/{name}\.txt(?:/[^/]*)?$", 1).alias("feed_id"))


def gtfs(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """trips, stop_times, calendar, calendar_dates of all feeds; ids as text, dates as dates."""
    day = {d: "int" for d in S.WEEKDAYS}
    out = {
        "trips": gtfs_table(spark, root, "trips", {"route_id": "string", "service_id": "string", "trip_id": "string", "direction_id": "int"}),
        "stop_times": gtfs_table(spark, root, "stop_times", {"trip_id": "string", "stop_id": "string", "arrival_time": "string", "departure_time": "string"}),
        "calendar": gtfs_table(spark, root, "calendar", {"service_id": "string"} | day | {"start_date": "string", "end_date": "string"}),
        "calendar_dates": gtfs_table(spark, root, "calendar_dates", {"service_id": "string", "date": "string", "exception_type": "int"}),
    }
    for table, cols in (("calendar", ("start_date", "end_date")), ("calendar_dates", ("date",))):
        out[table] = out[table].withColumns({c: tu.to_date_from_int(F.col(c)) for c in cols})
    return out


def feed_index(spark: SparkSession, path: str) -> DataFrame:
    """Feed versions in file order: feed_id (from the archive's name), start, end, position."""
    # partitions need not follow the file, lines within a block do
    df = csv(spark, path).withColumn("position", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("line")))
    dates = {new: tu.to_date_from_int(F.col(old)) for new, old in (("start", "feed_start_date"), ("end", "feed_end_date"))}
    return df.select(F.regexp_extract("archive_url", r"([^/]+?)(?:\.zip)?$", 1).alias("feed_id"), *[c.alias(n) for n, c in dates.items()], "position")


def scheduled_stops(stop_times: DataFrame, trips: DataFrame, trip_ids: DataFrame) -> DataFrame:
    """Scheduled stop events (trip, stop, arrival seconds, route, direction) of the trips in trip_ids (column trip_id)."""
    wanted = trips.join(trip_ids.select("trip_id"), "trip_id", "left_semi")
    seconds = F.col("arrival_time") if dict(stop_times.dtypes)["arrival_time"] in ("int", "bigint") else tu.seconds_of_time(F.col("arrival_time"))
    return stop_times.select("trip_id", "stop_id", seconds.cast("bigint").alias("arrival_time")).join(wanted.select("trip_id", "route_id", "direction_id"), "trip_id")


#: Folder, stop and stop of a percentile file's path.
PAIR_FILE = r"([^/]+)/([^_/]+)_([^/]+)\.csv\.gz$"


def pair_percentiles(spark: SparkSession, root: str, pattern: str = PAIR_FILE) -> DataFrame:
    """Daily p50 of stop pairs below root/color/from_to.csv.gz: color, from_stop, to_stop, service_date, p50, file.

    pattern: where color, from_stop and to_stop stand in a path, for other layouts. Other files, files without a name on
    both sides of the first underscore and values that are no numbers are left out.
    """
    df = spark.read.option("header", True).option("pathGlobFilter", "*.csv.gz").option("recursiveFileLookup", True).csv(root)
    if not {"service_date", "50%"} <= set(df.columns):
        return spark.createDataFrame([], "color string, from_stop string, to_stop string, service_date date, p50 double, file string")
    part = lambda i: F.regexp_extract("_metadata.file_path", pattern, i)
    file = F.regexp_extract("_metadata.file_path", pattern, 0)
    out = df.select(part(1).alias("color"), part(2).alias("from_stop"), part(3).alias("to_stop"), F.col("service_date").try_cast("date").alias("service_date"), F.col("`50%`").try_cast("double").alias("p50"), file.alias("file"))
    return out.filter("from_stop <> '' AND to_stop <> '' AND p50 IS NOT NULL AND service_date IS NOT NULL")


def first_file_per_stop(rows: DataFrame) -> DataFrame:
    """Of the files of a stop, the first by name that has any value."""
    w = Window.partitionBy("color", "from_stop").orderBy("file")
    return rows.withColumn("__n", F.dense_rank().over(w)).filter("__n = 1").drop("__n")
