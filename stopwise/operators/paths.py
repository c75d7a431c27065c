"""Travel-time benchmarks along paths of a stop network.

Two phases: all simple paths are enumerated on the network's topology alone (edges per colour, a small
graph whatever the number of days), then one join brings the daily values of all path components
together.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timeutil as tu
from ..functions.storage import materialize


def edges(segments: DataFrame, color: str = "color", start: str = "from_stop", end: str = "to_stop", value: str = "p50") -> DataFrame:
    """Distinct (color, from_stop, to_stop) that have a value on any day."""
    return segments.filter(F.col(value).isNotNull()).select(F.col(color).alias("color"), F.col(start).alias("from_stop"), F.col(end).alias("to_stop")).distinct()


def simple_paths(edge: DataFrame, max_length: int = 200, small: int = 20_000) -> DataFrame:
    """Rows (color, path): every path of at least one edge that visits no stop twice, as an array of stops.

    A network of up to `small` edges (counted) goes to all tasks, and each follows the paths that begin with its edges: one job
    whatever the lengths. A larger one is walked in rounds of joins. A path of more than max_length edges is an error.
    """
    edge = materialize(edge.select("color", "from_stop", "to_stop").distinct())
    first = edge.filter("from_stop <> to_stop")
    known = edge.limit(small + 1).collect() if small else []
    if 0 < len(known) <= small:
        onward: dict[tuple[str, str], list[str]] = {}
        for r in known:
            onward.setdefault((r.color, r.from_stop), []).append(r.to_stop)
        return first.repartition("color", "from_stop", "to_stop").mapInArrow(_walks(onward, max_length), "color string, path array<string>")
    return _rounds(edge, first, max_length)


def _walks(onward: dict[tuple[str, str], list[str]], max_length: int, rows: int = 10_000):
    """First edges to all simple paths that begin with them, depth first; a task holds one path and a batch of results."""

    def paths(color: str, *first: str) -> Iterator[list[str]]:
        path, ways = list(first), [iter(onward.get((color, first[-1]), ()))]
        yield path
        while ways:
            stop = next(ways[-1], None)
            if stop is None:
                ways.pop()
                path.pop()
            elif stop not in path:
                path.append(stop)
                if len(path) > max_length + 1:
                    raise ValueError(f"a path has more than {max_length} edges")
                yield path
                ways.append(iter(onward.get((color, stop), ())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        colors, found = [], []
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(colors, pa.string()), pa.array(found, pa.list_(pa.string()))], names=["color", "path"])
        for part in batches:
            for color, a, b in zip(*[part.column(c).to_pylist() for c in ("color", "from_stop", "to_stop")], strict=True):
                for path in paths(color, a, b):
                    colors.append(color)
                    found.append(list(path))
                    if len(found) >= rows:
                        yield batch()
                        colors, found = [], []
        yield batch()

    return run


def _rounds(edge: DataFrame, frontier: DataFrame, max_length: int) -> DataFrame:
    """A join for each length, the paths of one length written before the next."""
    frontier = frontier.select("color", F.array("from_stop", "to_stop").alias("path"))
    found = []
    for _ in range(max_length):
        frontier = materialize(frontier)
        if frontier.isEmpty():
            break
        found.append(frontier)
        here = frontier.withColumn("from_stop", F.element_at("path", -1))
        onward = here.join(edge, ["color", "from_stop"]).filter(~F.array_contains("path", F.col("to_stop")))
        frontier = onward.select("color", F.array_append("path", F.col("to_stop")).alias("path"))
    else:
        if not frontier.isEmpty():
            raise ValueError(f"a path has more than {max_length} edges")
    out = found[0] if found else frontier
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def daily_path_values(paths: DataFrame, segments: DataFrame, dwells: DataFrame) -> DataFrame:
    """Rows (color, path, service_date, value): sums of the segments and of the dwells at inner stops.

    A day counts only if all components have a value; an inner stop without any dwell value adds nothing
    and restricts nothing. segments: color, from_stop, to_stop, service_date, p50; dwells: color, from_stop,
    service_date, p50. Each has one row per edge or stop and day.
    """
    segment_facts = segments.filter("p50 is not null").select("color", F.concat(F.lit("s|"), F.col("from_stop"), F.lit("|"), F.col("to_stop")).alias("part"), "service_date", "p50")
    dwell_facts = dwells.filter("p50 is not null").select("color", F.concat(F.lit("d|"), F.col("from_stop")).alias("part"), "service_date", "p50")
    with_dwell = dwell_facts.select("color", "part").distinct().withColumn("known", F.lit(True))
    legs = F.transform(F.sequence(F.lit(1), F.size("path") - 1), lambda i: F.concat(F.lit("s|"), F.element_at("path", i), F.lit("|"), F.element_at("path", i + 1)))
    inner = F.when(F.size("path") > 2, F.transform(F.slice("path", F.lit(2), F.size("path") - 2), lambda s: F.concat(F.lit("d|"), s))).otherwise(F.array().cast("array<string>"))
    parts = paths.select("color", "path", F.explode(F.concat(legs, inner)).alias("part")).join(with_dwell, ["color", "part"], "left")
    parts = parts.filter(F.col("part").startswith("s|") | F.col("known")).drop("known")
    needed = parts.groupBy("color", "path").agg(F.count(F.lit(1)).alias("needed"))
    facts = segment_facts.unionByName(dwell_facts)
    sums = parts.join(facts, ["color", "part"]).groupBy("color", "path", "service_date").agg(F.sum("p50").alias("value"), F.count(F.lit(1)).alias("have"))
    return sums.join(needed, ["color", "path"]).filter("have = needed").select("color", "path", "service_date", "value")


def pair_benchmarks(values: DataFrame, min_days: int = 365, step: int = 30) -> DataFrame:
    """Rows (color, from_stop, to_stop, seconds): the median over enough days, rounded up to the step, the least of parallel paths."""
    usual = values.groupBy("color", "path").agg(F.count(F.lit(1)).alias("days"), F.median("value").alias("mid")).filter((F.col("days") >= min_days) & (F.col("mid") > 0))
    ends = usual.select("color", F.element_at("path", 1).alias("from_stop"), F.element_at("path", -1).alias("to_stop"), tu.ceil_to(F.col("mid"), step).alias("seconds"))
    return ends.groupBy("color", "from_stop", "to_stop").agg(F.min("seconds").alias("seconds"))


def benchmark_documents(pairs: DataFrame) -> DataFrame:
    """One JSON document per colour: {"color": .., "benchmarks": {"from|to": seconds}}. A document holds a network's pairs, not its days."""
    entry = F.struct(F.concat_ws("|", "from_stop", "to_stop").alias("pair"), "seconds")
    by = pairs.groupBy("color").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("benchmarks"))
    return by.select("color", F.to_json(F.struct("color", "benchmarks")).alias("document"))
