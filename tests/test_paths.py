import datetime as dt
import json
import random
from statistics import median

import pytest

from stopwise.operators import paths
from stopwise.plans import jobs
from stopwise.sources import readers

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(6)]


def _facts(spark, rows):
    return spark.createDataFrame([("c", a, b, d, float(v)) for (a, b), series in rows.items() for d, v in series.items()], "color string, from_stop string, to_stop string, service_date date, p50 double")


def _brute(segments, dwells, min_days, step):
    """Depth-first over simple paths, day by day."""
    out = {}

    def walk(path, series):
        for (a, b), more in segments.items():
            if a == path[-1] and b not in path:
                at = dict(more) if series is None else {d: series[d] + more[d] + (dwells.get(a, {d: 0}).get(d)) for d in series if d in more and (a not in dwells or d in dwells[a])}
                if len(at) >= min_days and (m := median(at.values())) > 0:
                    v = int(-(-m // step) * step)
                    out[path[0], b] = min(out.get((path[0], b), v), v)
                walk([*path, b], at)

    for start in {a for a, _ in segments}:
        walk([start], None)
    return out


def test_random_networks(spark):
    rng = random.Random(2)
    for _ in range(4):
        pairs = [(a, b) for a in "ABCDE" for b in "ABCDE" if a != b and rng.random() < 0.35]
        segments = {p: {d: rng.randint(20, 200) for d in DAYS if rng.random() < 0.85} for p in pairs}
        segments = {p: s for p, s in segments.items() if s}
        dwells = {s: {d: rng.randint(5, 60) for d in DAYS if rng.random() < 0.9} for s in "BCD"}
        got = jobs.benchmarks(_facts(spark, segments), _facts(spark, {(s, "x"): v for s, v in dwells.items() if v}), min_days=3)
        assert {(r.from_stop, r.to_stop): r.seconds for r in got.collect()} == _brute(segments, {k: v for k, v in dwells.items() if v}, 3, 30)


def test_document(spark):
    df = spark.createDataFrame([("red", "B", "C", 60), ("red", "A", "B", 30)], "color string, from_stop string, to_stop string, seconds int")
    assert json.loads(paths.benchmark_documents(df).first().document) == {"color": "red", "benchmarks": {"A|B": 30, "B|C": 60}}


def test_percentile_files(spark, tmp_path):
    import gzip

    (tmp_path / "red").mkdir()
    for name, text in {"1_2_3.csv.gz": "service_date,50%\n2024-01-01,91.0\n2024-01-02,\n2024-01-03,bad\n", "_2.csv.gz": "service_date,50%\n2024-01-01,1\n", "1_9.csv.gz": "service_date,50%\n2024-01-01,5\n"}.items():
        (tmp_path / "red" / name).write_bytes(gzip.compress(text.encode()))
    (tmp_path / "red" / "note.txt").write_text("x")
    rows = readers.pair_percentiles(spark, str(tmp_path))
    assert {(r.color, r.from_stop, r.to_stop, r.p50) for r in rows.collect()} == {("red", "1", "2_3", 91.0), ("red", "1", "9", 5.0)}
    assert [r.to_stop for r in readers.first_file_per_stop(rows).collect()] == ["2_3"]


def _jobs(spark, work):
    """How many jobs work() starts."""
    from uuid import uuid4

    group = uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    work()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_paths_in_one_job_whatever_their_length(spark):
    chain = lambda n: spark.createDataFrame([("c", f"s{i}", f"s{i + 1}") for i in range(n)] + [("c", "s0", "s0")], "color string, from_stop string, to_stop string")
    short, long = (_jobs(spark, lambda n=n: paths.simple_paths(chain(n)).count()) for n in (3, 60))
    assert short == long
    assert paths.simple_paths(chain(60)).count() == 60 * 61 // 2
    by_rounds = paths.simple_paths(chain(6), small=0)
    assert sorted(r.path for r in by_rounds.collect()) == sorted(r.path for r in paths.simple_paths(chain(6)).collect())
    none = spark.createDataFrame([], "color string, from_stop string, to_stop string")
    assert paths.simple_paths(none).count() == 0


def test_paths_longer_than_allowed(spark):
    edge = spark.createDataFrame([("c", f"s{i}", f"s{i + 1}") for i in range(5)], "color string, from_stop string, to_stop string")
    for small in (0, 100):
        with pytest.raises(Exception, match="more than 3 edges"):
            paths.simple_paths(edge, 3, small).count()
