import random
from functools import partial

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stopwise.functions.joins import join_checked
from stopwise.operators import asof
from stopwise.operators.asof import asof_join


def _frames(spark, left, right):
    return spark.createDataFrame(left, "id long, k string, t long"), spark.createDataFrame(right, "k string, t long, v string")


def _run(spark, left, right, **options):
    l, r = _frames(spark, left, right)
    rows = asof_join(l, r, "t", ["k"], ["v"], tie_break=["v"], **options).collect()
    return {x.id: x.v for x in rows}


RIGHT = [("a", 10, "x"), ("a", 20, "y1"), ("a", 20, "y2"), ("a", 40, "z1"), ("a", 40, "z2"), (None, 5, "n")]


@pytest.mark.parametrize("width", [None, 7.0, 1000.0])
@pytest.mark.parametrize(
    ("t", "options", "want"),
    [
        (9, {}, None),
        (10, {}, "x"),
        (10, {"allow_exact": False}, None),
        (20, {}, "y2"),
        (20, {"allow_exact": False}, "x"),
        (25, {}, "y2"),
        (30, {"direction": "nearest"}, "y2"),  # a tie prefers backward, its last row
        (31, {"direction": "nearest"}, "z1"),  # forward takes the first row
        (40, {"direction": "nearest"}, "z2"),  # an exact match counts as backward
        (1, {"direction": "nearest"}, "x"),
        (99, {"direction": "nearest"}, "z2"),
    ],
)
def test_rules(spark, t, options, want, width):
    assert _run(spark, [(1, "a", t)], RIGHT, slice_width=width, **options) == {1: want}


def test_null_keys_meet_and_null_places_match_nothing(spark):
    assert _run(spark, [(1, None, 7), (2, "a", None), (3, "b", 7)], RIGHT) == {1: "n", 2: None, 3: None}


def test_empty_sides(spark):
    assert _run(spark, [], RIGHT) == {}
    assert _run(spark, [(1, "a", 1)], []) == {1: None}
    assert _run(spark, [(1, "a", 1)], [], slice_width=5.0, direction="nearest") == {1: None}


@pytest.mark.parametrize("width", [None, 13.0])
@pytest.mark.parametrize(("direction", "exact"), [("backward", True), ("backward", False), ("nearest", True)])
def test_against_pandas(spark, direction, exact, width):
    rng = random.Random(4)
    left = [(i, rng.choice("abc"), rng.randrange(300)) for i in range(400)]
    right = sorted(((rng.choice("abd"), rng.randrange(300), f"{i:04}") for i in range(150)), key=lambda r: (r[1], r[2]))
    want = pd.merge_asof(
        pd.DataFrame(left, columns=["id", "k", "t"]).sort_values("t", kind="stable"),
        pd.DataFrame(right, columns=["k", "t", "v"]),
        on="t",
        by="k",
        direction=direction,
        allow_exact_matches=exact,
    )
    want = {r.id: None if pd.isna(r.v) else r.v for r in want.itertuples()}
    assert _run(spark, left, right, direction=direction, allow_exact=exact, slice_width=width) == want


def test_one_exchange(spark):
    l, r = _frames(spark, [(1, "a", 1)], RIGHT)
    plan = asof_join(l, r, "t", ["k"], ["v"], "nearest")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_busy_keys_are_cut_where_their_rows_lie(spark):
    """A key of a third of all rows comes in many slices, the others whole; the result is that without slices."""
    rng = random.Random(3)
    key = lambda: rng.choice(["hot", f"k{rng.randrange(60)}", f"k{rng.randrange(60)}"])
    at = lambda: int(rng.gauss(40_000, 3_000))
    left = spark.createDataFrame([(key(), at(), i) for i in range(6000)] + [(None, 5, -1), ("hot", None, -2)], "k string, t long, i long")
    right = spark.createDataFrame([(key(), at(), i) for i in range(3000)] + [(None, 3, -1)], "k string, t long, m long")
    plain, cut = (asof_join(left, right, "t", ["k"], ["m"], "nearest", tie_break=["m"], slice_rows=n) for n in (None, 200))
    assert sorted((r.i, r.m) for r in plain.collect() if r.m is not None) == sorted((r.i, r.m) for r in cut.collect() if r.m is not None)
    assert cut.count() == 6002
    cuts = asof._cuts(*[d.select(F.col("k").alias("__k0"), F.col("t").alias("__at")) for d in (left, right)], ["__k0"], 60.0, 200)
    assert cuts.select("__hash").distinct().count() == 1  # only the busy key
    sliced = asof._sliced(left.select(F.col("k").alias("__k0"), F.col("t").alias("__at")), cuts, ["__k0"], 60.0)
    sizes = {(r["__k0"], r["__slice"]): r["count"] for r in sliced.groupBy("__k0", "__slice").count().collect()}
    assert max(n for (k, _), n in sizes.items() if k == "hot") < 300 and len([1 for k, _ in sizes if k == "hot"]) > 8
    assert not asof_join(left, right, "t", ["k"], ["m"], slice_rows=10**6)._jdf.queryExecution().toString().count("__slice")


@pytest.mark.parametrize("salts", [1, 32])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_a_side_of_many_rows_is_not_broadcast(spark, tmp_path, how, salts):
    """the files of a side may be small where its copies for the salts are not."""
    spark.range(300).select((F.col("id") * 2).alias("k"), F.lit("v").alias("v")).write.parquet(str(tmp_path / "side"))
    rows, side = spark.range(1000).select(F.col("id").alias("k")), spark.read.parquet(str(tmp_path / "side"))
    out = join_checked(rows, side, ["k"], how, max_rows=100, salts=salts)
    assert sorted(r.k for r in out.collect()) == sorted(r.k for r in rows.join(side, "k", how).collect())
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_many_cuts(spark, tmp_path, monkeypatch):
    """cuts beyond what is broadcast give the result of one slice, without a broadcast."""
    rng = random.Random(5)
    row = lambda i: (rng.choice("ab"), int(rng.gauss(40_000, 3_000)), i)
    for name in ("left", "right"):
        spark.createDataFrame([row(i) for i in range(2000)] + [(None, 5, -1), ("a", None, -2)], "k string, t long, i long").write.parquet(str(tmp_path / name))
    left, right = (spark.read.parquet(str(tmp_path / n)) for n in ("left", "right"))
    right = right.withColumnRenamed("i", "m")
    monkeypatch.setattr(asof, "join_checked", partial(join_checked, max_rows=1))
    plain, cut = (asof_join(left, right, "t", ["k"], ["m"], "nearest", tie_break=["m"], slice_rows=n) for n in (None, 5))
    assert sorted((r.i, r.m if r.m is not None else -9) for r in plain.collect()) == sorted((r.i, r.m if r.m is not None else -9) for r in cut.collect())
    assert "Broadcast" not in cut._jdf.queryExecution().executedPlan().toString()
