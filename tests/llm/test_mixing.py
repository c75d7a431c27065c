from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from stopwise.llm import mixing as m

from .helpers import ODD, empty, odd, prose, words


def brute_targets(sizes, epochs=3):
    """Share by weight, cap, give the excess to the others, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: Fraction(i % 3 + 1) for i, s in enumerate(names)}
    total, capped = Fraction(sum(sizes.values())), {}
    while True:
        open_ = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        w = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / w > epochs * sizes[s]]
        if not over:
            return {s: float(capped[s] if s in capped else left * weight[s] / w) for s in names}
        capped |= {s: Fraction(epochs * sizes[s]) for s in over}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 10, "c": 500, "d": 7}, {"a": 5, None: 1000}, {"b": 1}, {"a": 0, "b": 40, "c": 40}, {"é": 90, "z": 30, "Z": 60, "zz": 400, None: 3}])
def test_water_filling(spark, sizes):
    rows = [(i, prose(i, n), "en", s, 0) for i, (s, n) in enumerate(sizes.items()) if n] + [(99, "", "en", s, 0) for s, n in sizes.items() if not n]
    got = {r.source: r.target for r in m.mix(odd(spark, rows)).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_taken_is_near_the_target_and_repeatable(spark):
    rows = [(i, prose(i, 5 + i * 7 % 60), "en", f"s{0 if i % 3 else i % 5}", 0) for i in range(900)]
    one, two = (sorted((r.doc_id, r.size, r.copies, r.taken, r.source, r.target) for r in m.mix(odd(spark, rows)).collect()) for _ in range(2))
    assert one == two
    for s in {r[4] for r in one}:
        of = [r for r in one if r[4] == s]
        assert abs(sum(r[3] for r in of) - of[0][5]) <= 33
    assert all(0 <= r[3] <= 3 * r[1] and r[1] == len(words(rows[r[0]][1])) for r in one)
    again = m.repeat(m.mix(odd(spark, rows)))
    assert again.count() == sum(r[2] for r in one) and again.columns == odd(spark).columns


def test_odd_rows(spark):
    out = m.mix(odd(spark).withColumns({"Target": F.lit("old"), "copies": F.lit("old")})).collect()
    assert len(out) == len(ODD)
    assert all(r["size"] == len(words(r.text)) and r.taken <= 3 * r["size"] for r in out)
    same = {r.copies for r in out if r.doc_id == 6}
    assert len(same) == 1
    assert m.mix(empty(spark)).count() == 0 and m.repeat(m.mix(empty(spark))).count() == 0


def test_given_weights(spark):
    rows = [(i, prose(i, 10), "en", "ab"[i % 2], 0) for i in range(100)]
    weights = spark.createDataFrame([("a", 3), ("b", 1)], "source string, weight long")
    assert {r.source: r.target for r in m.mix(odd(spark, rows), weights=weights).collect()} == {"a": 750.0, "b": 250.0}
