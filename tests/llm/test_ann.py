import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopwise.llm import ann

from .helpers import SF

VECTORS = "vec_id long, embedding array<float>"


def _table(spark, x, start=0):
    return spark.createDataFrame([(start + i, [float(c) for c in v]) for i, v in enumerate(x)], VECTORS)


def _brute(ids, x, q, k):
    s = x @ x[q]
    order = sorted((i for i in range(len(x)) if i != q), key=lambda i: (-s[i], ids[i]))[:k]
    return [ids[i] for i in order]


@pytest.mark.parametrize("spread", [0.0, 0.6])
def test_recall(spark, spread):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 24)) * np.exp(spread * rng.normal(size=(1500, 1)))
    x = x.astype(np.float32).astype(float)
    got = {}
    for r in ann.nearest(_table(spark, x), F.col("id") % 50 == 0, 10).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, r.score))
    assert len(got) == 30
    hits = [len({i for i, _ in got[q]} & set(_brute(range(1500), x, q, 10))) / 10 for q in got]
    assert np.mean(hits) >= 0.9
    for q, found in got.items():
        assert len(found) == 10 and [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        assert all(abs(s - float(x[i] @ x[q])) < 1e-9 for i, s in found)


@pytest.mark.parametrize("within, radius", [(0, 500), (1, 500), (2, 30), (3, 80)])
def test_what_is_retrieved_equals_brute_force(spark, within, radius, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 16))
    rows = ann.usable(_table(spark, x), "vec_id", "embedding")
    model = ann.fit(rows, 3).first(3, within, radius)
    queries = rows.filter("id % 30 = 0")
    found = {(r.q, r.id) for r in ann.search(rows, queries, model, 400, block_queries=4).collect()}
    v = {r.id: r.v for r in rows.collect()}
    ids = sorted(v)
    have = model.codes(np.array([v[i] for i in ids], float))
    want = set()
    for q in (i for i in ids if i % 30 == 0):
        ask = model.codes(np.array([v[q]], float), True)[0]
        for i, c in zip(ids, have, strict=True):
            off = [int(a) ^ int(b) for a, b in zip(c, ask, strict=True)]
            subs = [(o >> (16 * t) & 0xFFFF).bit_count() for o in off for t in range(4)]
            if i != q and min(subs) <= within and sum(o.bit_count() for o in off) <= radius:
                want.add((q, i))
            # the pigeonhole radius of each code is covered
            assert min(o.bit_count() for o in off) > 4 * within + 3 or min(subs) <= within
    assert found == want


def test_recall_on_the_given_table(spark):
    """The query's own table and parameters against brute force; and the index saves work where vectors lie in clusters."""
    got = {}
    for r in ann.op9_ann(spark, SF).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r.embedding and all(c is not None and math.isfinite(c) for c in r.embedding) and any(r.embedding)}
    ids, x = sorted(rows), np.array([rows[i] for i in sorted(rows)], float)
    hits = [len(got[i] & set(_brute(ids, x, p, 20))) / min(20, len(ids) - 1) for p, i in enumerate(ids) if i % 20 == 0]
    assert len(hits) == len(got) and np.mean(hits) >= 0.9
    rng = np.random.default_rng(6)
    near = np.repeat(rng.normal(size=(40, 32)), 60, axis=0) + 0.1 * rng.normal(size=(2400, 32))
    table = ann.usable(_table(spark, near), "vec_id", "embedding")
    model = ann.tune(table, table.filter("id % 20 = 0"), ann.fit(table), 20, 0.94, 200)
    retrieved, reranked = ann.effort(table, table.filter("id % 20 = 0"), model)
    assert model.within <= 1 and reranked <= retrieved < 0.2


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (5, [0.0, 0.0]), (6, None), (7, [1.0, None]), (8, [math.nan, 1.0]), (9, [math.inf, 1.0]), (None, [1.0, 1.0]), (10, [1.0]), (11, [0.5, 0.1]), (40, None)]
    df = spark.createDataFrame(rows, VECTORS).withColumns({"score": F.lit("old"), "rank": F.lit("old")})
    got = [(r.query_id, r["rank"], r.id) for r in ann.nearest(df, F.col("id") % 20 == 0, 3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2), (0, 2, 3), (0, 3, 20), (20, 1, 0), (20, 2, 2), (20, 3, 3)]
    assert ann.nearest(df, F.col("id") % 20 == 0, 50).filter("query_id = 0").count() == 4
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0
    assert ann.nearest(df.filter("vec_id = 0"), F.lit(True)).count() == 0


def test_many_equal_vectors(spark):
    x = np.vstack([np.tile([[1.0, 2.0, 3.0]], (700, 1)), np.random.default_rng(0).normal(size=(200, 3))])
    got = [r.id for r in ann.nearest(_table(spark, x), F.col("id") == 5, 20).orderBy("rank").collect()]
    assert len(got) == 20 and all(x[i] @ x[5] >= x[5] @ x[5] - 1e-6 for i in got)
