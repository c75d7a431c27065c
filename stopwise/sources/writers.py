"""Sinks: events by stop and day or month, benchmark documents.

Each key is one folder whose files follow its order: normally one file; a busy key is cut by ranges of the order into
several, whose names sort in that order. A rerun replaces the folders of keys it writes; given the dates that it
recomputes, it also clears the folders of those dates that no longer have rows, which a manifest knows. Rows with a null
key are left out. Key columns are copies, so the files keep the originals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import join_checked
from ..functions.storage import delete, exists, key_folder, materialize, shared_dir

_EVENT_TIME = "yyyy-MM-dd HH:mm:ss"
#: Rows that one file of a busy key takes.
ROWS_PER_FILE = 2_000_000
#: Files of busy keys that one task writes, where files are small. Spark numbers those of a key and task by three digits, so their names sort up to 1,000.
FILES_PER_TASK = 400
#: Folder of the manifest (readers pass over names with an underscore).
MANIFEST = "_folders"


def write_by_key(df: DataFrame, path: str, keys: dict[str, Column], order: Sequence[str] = (), compression: str = "none", rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Write df below path/key=value/.. in the order of each key; dynamic overwrite. Returns the distinct keys written.

    A key of more than rows_per_file rows is dealt by ranges of the order, so that no task takes it whole; a task cuts its range
    into files.
    """
    names = list(keys)
    # rows of one place in the order can be cut, too
    rows = materialize(df.withColumns(keys).dropna(subset=names).withColumn("__tie", F.monotonically_increasing_id()))
    counts = materialize(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")))
    busy = counts.filter(F.col("__n") > rows_per_file)
    files = busy.agg(F.sum(F.ceil(F.col("__n") / rows_per_file))).first()[0]
    cols = [F.col(f"`{c}`") for c in (*names, *order, "__tie")]
    if files:
        tasks = -(-int(files) // max(1, min(FILES_PER_TASK, ROWS_PER_FILE // rows_per_file)))
        split = join_checked(rows, busy.select(*names), names, "left_semi").repartitionByRange(tasks, *cols)
        out = join_checked(rows, busy.select(*names), names, "left_anti").repartition(*cols[: len(names)]).unionByName(split)
    else:
        out = rows.repartition(*cols[: len(names)])
    writer = out.sortWithinPartitions(*cols).drop("__tie").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*names)
    # tasks move their own files to the staging folder, from which the job moves whole folders
    writer = writer.option("maxRecordsPerFile", rows_per_file).option("mapreduce.fileoutputcommitter.algorithm.version", 2)
    writer.option("header", True).option("compression", compression).csv(path)
    return counts.drop("__n")


def read_placed(df_reader, path: str, keys: Sequence[str]) -> DataFrame:
    """Rows of a sink with `place`: a row's number among those of its key, from 0, by file name and line. df_reader: a DataFrameReader with the CSV options
    (for very many files that of `for_small_files`, and with a schema, as Spark lists all files once more to find one)."""
    raw = df_reader.csv(path)
    at = {"__file": F.col("_metadata.file_name"), "__block": F.col("_metadata.file_block_start"), "__line": F.monotonically_increasing_id()}
    raw = materialize(raw.select("*", *[c.alias(n) for n, c in at.items()]))
    where = [*keys, "__file", "__block"]
    blocks = raw.groupBy(*where).agg(F.min("__line").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*keys).orderBy("__file", "__block")) - F.col("__n")
    blocks = materialize(blocks.withColumn("__before", before).drop("__n"))
    # a block is what one task has read
    return join_checked(raw, blocks, where, salts=1).withColumn("place", F.col("__before") + F.col("__line") - F.col("__first")).drop("__file", "__block", "__line", "__first", "__before")


def _date_keys(date: str, day: bool) -> dict[str, Column]:
    d = F.col(date).cast("date")
    return {"Year": F.year(d), "Month": F.month(d)} | ({"Day": F.dayofmonth(d)} if day else {})


def write_daily(events: DataFrame, path: str, dates: DataFrame | None = None, order: Sequence[str] = ("event_time",), rows_per_file: int = ROWS_PER_FILE) -> None:
    """Events by stop and day, plain CSV. dates (service_date): what this run recomputes; a stop's folder of such a date goes if the run has no rows for it."""
    keys = {"stop": F.col("stop_id")} | _date_keys("service_date", True)
    if dates is None:
        write_by_key(events, path, keys, order, rows_per_file=rows_per_file)
        return
    scope = materialize(dates.select(*[c.alias(n) for n, c in _date_keys("service_date", True).items()]).dropna().distinct())
    known = _manifest(scope, path)
    written = write_by_key(events, path, keys, order, rows_per_file=rows_per_file)
    # until the stale folders are gone the manifest names them, so a run that ends here is made good by the next one
    _write_manifest(written.unionByName(known).distinct(), scope, path)
    gone = known.join(written, list(keys), "left_anti")
    for row in gone.toLocalIterator():  # names of folders alone
        delete(events.sparkSession, f"{path.rstrip('/')}/{key_folder(list(keys), list(row))}")
    _write_manifest(written, scope, path)


def _manifest(scope: DataFrame, path: str) -> DataFrame:
    """Folders (stop and date) that runs with a manifest left for the dates in scope."""
    spark, at = scope.sparkSession, f"{path.rstrip('/')}/{MANIFEST}"
    schema = ", ".join(["stop string", *[f"{n} {t}" for n, t in scope.dtypes]])
    if not exists(spark, at):
        return spark.createDataFrame([], schema)
    days = spark.read.schema(schema).parquet(at)
    return materialize(join_checked(days.filter("stop is not null"), scope, scope.columns, "left_semi").select("stop", *scope.columns))


def _write_manifest(folders: DataFrame, scope: DataFrame, path: str) -> None:
    """Replace the manifest of the dates in scope; a date without folders keeps an empty entry."""
    entries = folders.select(F.col("stop").cast("string").alias("stop"), *scope.columns).unionByName(scope.withColumn("stop", F.lit(None).cast("string")))
    entries.repartition(*scope.columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*scope.columns).parquet(f"{path.rstrip('/')}/{MANIFEST}")


def write_monthly(events: DataFrame, path: str, compressed: bool = True, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Events by stop and month."""
    write_by_key(events, path, {"stop": F.col("stop_id")} | _date_keys("service_date", False), ["event_time"], "gzip" if compressed else "none", rows_per_file)


def joined_key(separator: str) -> Column:
    """route, direction and stop in one name (null if one is null)."""
    cols = [F.col(c).cast("string") for c in ("route_id", "direction_id", "stop_id")]
    return F.concat(cols[0], F.lit(separator), cols[1], F.lit(separator), cols[2])


def write_ferry(events: DataFrame, path: str, compressed: bool = True) -> None:
    write_by_key(events, path, {"key": joined_key("|")} | _date_keys("service_date", False), ["event_time"], "gzip" if compressed else "none")


def write_bus(events: DataFrame, path: str, compressed: bool = True) -> None:
    """Bus events; dates and times as local text."""
    text = events.withColumns({"service_date": F.date_format("service_date", "yyyy-MM-dd"), "event_time": F.date_format(F.col("event_time").cast("timestamp"), _EVENT_TIME)})
    write_by_key(text, path, {"key": joined_key("-")} | _date_keys("service_date", False), ["event_time"], "gzip" if compressed else "none")


def write_benchmarks(documents: DataFrame, path: str) -> None:
    """One text file per colour."""
    writer = documents.select("color", "document").repartition("color").write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("color").text(path)


def round_trip(df: DataFrame, write, **options) -> DataFrame:
    """Write with one of the sinks to a new shared folder and read the CSV back, partition columns included."""
    path = shared_dir(df.sparkSession)
    write(df, path, **options)
    return df.sparkSession.read.option("header", True).csv(path)
