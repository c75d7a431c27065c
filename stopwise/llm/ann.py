"""Approximate nearest neighbours (largest inner product): multi-index hashing of learned binary codes.

Fit, on at most `max_train` rows chosen by hashed id: vectors are scaled by the largest norm and get one
more component that makes their length 1 (so the order by inner product is an order by angle, whatever the
norms), are projected to their principal directions and rotated so that signs lose least (iterative
quantisation), from several starts. Each start gives a code of 64 bits.

Index. A code is cut into 4 substrings of 16 bits, each with a table of buckets. A query probes in each table the
buckets within s bits of its own substring (masks enumerated once). By the pigeonhole argument that retrieves
every vector one of whose codes lies within radius 4 s + 3 of the query's. What is retrieved goes on if all
codes together are within a second, learned radius, and is reranked with the original floats in double
precision.

s, the number of codes and the second radius are learned: up to `probe_queries` queries are compared with all rows,
the least s is taken with which at most `max_codes` codes retrieve the share `recall` of their true
neighbours, then the fewest codes, then the radius that keeps 0.995 of those. Where vectors lie in clusters s is 0
or 1 and few buckets are read; where they are uniform on a sphere no index can read few (figures in the
README). Queries that find fewer than k go through all rows in blocks.

Distribution: blocks of rows (by a hash of the id) x blocks of queries; each task builds the tables of its
block, so only vectors are shuffled, each row once for each block of `block_queries` queries and each query once
for each block of rows. Equal vectors are spread over blocks like all others. A task never holds more than
one block of each, and sends at most k rows per query.

Defined cases: rows whose id is null, or whose vector is null, zero, of another length than most, or holds
null or non-finite components take no part; rows that repeat an id are one candidate (the least vector
counts); ties go to the smaller id; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_sample, materialize, table

_SUB = 16
_BITS = 64
_TABLES = _BITS // _SUB


@dataclass(frozen=True)
class Model:
    dim: int
    scale: float  # largest norm
    projections: np.ndarray  # (dim + 1, 64 x codes)
    within: int = 2  # bits by which a probed bucket may differ
    radius: int = 1 << 30  # bits by which all codes together may differ

    @property
    def codes_used(self) -> int:
        return self.projections.shape[1] // _BITS

    def first(self, codes: int, within: int, radius: int) -> Model:
        return replace(self, projections=self.projections[:, : codes * _BITS], within=within, radius=radius)

    def codes(self, x: np.ndarray, queries: bool = False) -> np.ndarray:
        """Each row's codes, as uint64."""
        if queries:
            last, x = np.zeros((len(x), 1)), x / np.linalg.norm(x, axis=1, keepdims=True)
        else:
            x = x / self.scale
            last = np.sqrt(np.maximum(0.0, 1 - (x * x).sum(1, keepdims=True)))
        on = np.hstack([x, last]) @ self.projections > 0
        return np.packbits(on, axis=1, bitorder="little").view("<u8").copy()


def masks(within: int) -> np.ndarray:
    """All patterns of 16 bits with at most so many ones."""
    every = np.arange(1 << _SUB, dtype=np.uint16)
    return every[np.bitwise_count(every) <= within]


def itq(x: np.ndarray, bits: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Projection to `bits` principal directions, then the rotation that brings them closest to signs."""
    values, vectors = np.linalg.eigh(x.T @ x)
    main = vectors[:, np.argsort(-values, kind="stable")[:bits]]
    if main.shape[1] < bits:  # short vectors: the rest of the bits are random directions
        main = np.hstack([main, rng.normal(size=(x.shape[1], bits - main.shape[1])) / math.sqrt(x.shape[1])])
    z = x @ main
    r = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        u, _, vt = np.linalg.svd(np.where(z @ r > 0, 1.0, -1.0).T @ z)
        r = (u @ vt).T
    return main @ r


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (id, v) that take part, one per id."""
    v = F.col(f"`{vector_col}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0))
    rows = materialize(rows.groupBy("id").agg(F.min("v").alias("v")))
    dim = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == dim.n) if dim else rows


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def fit(rows: DataFrame, max_codes: int = 32, max_train: int = 4096) -> Model | None:
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    scale = rows.agg(F.max(norm)).first()[0]
    if scale is None:
        return None

    def train(_key, pdf):
        x = _matrix(pdf.sort_values("id")["v"]) / scale
        x = np.hstack([x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(1, keepdims=True)))])
        rng = np.random.default_rng(3)
        p = np.hstack([itq(x, _BITS, rng) for _ in range(max_codes)])
        return pd.DataFrame({"dim": [x.shape[1] - 1], "p": [p.ravel()]})

    got = bounded_sample(rows, F.col("id"), max_train).groupBy(F.lit(0).alias("k")).applyInPandas(train, "dim int, p array<double>").first()
    return Model(got.dim, scale, np.array(got.p).reshape(got.dim + 1, -1))


def _top(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to smaller ids."""
    if len(score) > 4 * k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        return at[np.lexsort((ids[at], -score[at]))[:k]]
    return np.lexsort((ids, -score))[:k]


def tune(rows: DataFrame, queries: DataFrame, model: Model, k: int, recall: float, probe_queries: int) -> Model:
    """Choose how far to probe, the number of codes and the radius from the true neighbours of some queries."""
    some = bounded_sample(queries, F.col("id"), probe_queries).limit(2 * probe_queries).collect()
    shared = rows.sparkSession.sparkContext.broadcast((np.array([r.id for r in some]), np.array([r.v for r in some], np.float64)))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qid, q = shared.value
        for pdf in parts:
            ids = pdf["id"].to_numpy()
            for lo in range(0, len(pdf), 4096):
                x = _matrix(pdf["v"].iloc[lo : lo + 4096])
                own = ids[lo : lo + 4096]
                s = q @ x.T
                s[qid[:, None] == own[None, :]] = -np.inf
                for i in range(len(q)):
                    best = _top(s[i], own, k)
                    best = best[s[i, best] > -np.inf]
                    if len(best):
                        yield pd.DataFrame({"q": qid[i], "id": own[best], "s": s[i, best], "v": list(x[best])})

    w = Window.partitionBy("q").orderBy(F.desc("s"), "id")
    near = rows.mapInPandas(run, "q long, id long, s double, v array<double>").withColumn("n", F.row_number().over(w)).filter(F.col("n") <= k)
    pairs = near.select("q", "v").toPandas()  # at most 2 x probe_queries x k rows
    if not len(pairs):
        return model
    place = {r.id: i for i, r in enumerate(some)}
    qc = model.codes(np.array([r.v for r in some], np.float64), True)[[place[i] for i in pairs["q"]]]
    off = qc ^ model.codes(_matrix(pairs["v"]))
    nearest_part = np.bitwise_count(off.view(np.uint16).reshape(len(off), -1, _TABLES)).min(2)  # by code: the least distance of a substring
    within, codes, share = 0, 0, 0.0
    for within in range(_SUB + 1):
        found = np.logical_or.accumulate(nearest_part <= within, axis=1).mean(0)
        if found[-1] >= recall:
            codes = int(np.argmax(found >= recall)) + 1
            share = float(found[codes - 1])
            break
    far = np.bitwise_count(off[:, :codes]).sum(1, dtype=np.int64)
    seen = (nearest_part[:, :codes] <= within).any(1)
    return model.first(codes, within, int(np.quantile(far[seen], 0.995, method="higher")) if share else 1 << 30)


class Block:
    """The tables of a block of rows."""

    def __init__(self, model: Model, ids: np.ndarray, x: np.ndarray) -> None:
        self.model, self.ids, self.x = model, ids, x
        self.code = model.codes(x)
        sub = self.code.view(np.uint16)  # rows x tables
        self.order = np.argsort(sub, axis=0, kind="stable").T.astype(np.int32)
        n, tables = sub.shape
        count = np.zeros((tables, (1 << _SUB) + 1), np.int64)
        for t in range(tables):
            count[t, 1:] = np.bincount(sub[:, t], minlength=1 << _SUB)
        self.start = np.cumsum(count, axis=1) + (np.arange(tables) * n)[:, None]
        self.start, self.flat = self.start.ravel(), self.order.ravel()
        self.base = np.arange(tables)[:, None] * ((1 << _SUB) + 1)
        self.masks = masks(model.within)

    def retrieve(self, code: np.ndarray) -> np.ndarray:
        """Rows in the probed buckets of any table."""
        at = (self.base + (code.view(np.uint16)[:, None] ^ self.masks)).ravel()
        first = self.start[at]
        w = self.start[at + 1] - first
        hit = w > 0
        first, w = first[hit], w[hit]
        mark = np.zeros(len(self.ids), bool)
        mark[self.flat[np.repeat(first - (np.cumsum(w) - w), w) + np.arange(w.sum())]] = True
        return np.flatnonzero(mark)

    def near(self, code: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of the rows `at`, those whose codes are all together within the radius."""
        return at[np.bitwise_count(self.code[at] ^ code).sum(1, dtype=np.int64) <= self.model.radius]


def search(rows: DataFrame, queries: DataFrame, model: Model, k: int, whole: bool = False, block_queries: int = 16_384) -> DataFrame:
    """The k best rows that each query retrieves in each block (q, id, s). whole: every row is reranked.

    rows, queries: id, v. Blocks hold 8,192 rows, or a 64th of all where that is more, up to 65,536.
    """
    n, nq = rows.count(), queries.count()
    parts = max(1, math.ceil(n / min(65_536, max(8_192, math.ceil(n / 64)))))
    asks = max(1, math.ceil(nq / block_queries))
    shared = rows.sparkSession.sparkContext.broadcast(model)
    block = lambda c, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.lit(c - 1)))
    have = rows.select("id", "v", block(parts, "rows").alias("part"), every(asks).alias("ask"))
    want = queries.select("id", "v", block(asks, "queries").alias("ask"), every(parts).alias("part"))

    def probe(_key, have, ask):
        out: list[pd.DataFrame] = []
        if len(have) and len(ask):
            ids, x = have["id"].to_numpy(), _matrix(have["v"])
            qid, q = ask["id"].to_numpy(), _matrix(ask["v"])
            index = None if whole else Block(shared.value, ids, x)
            code = None if whole else shared.value.codes(q, True)
            for i in range(len(ask)):
                at = np.arange(len(ids)) if whole else index.near(code[i], index.retrieve(code[i]))
                at = at[ids[at] != qid[i]]
                if len(at):
                    score = (x[at] * q[i]).sum(1)
                    best = _top(score, ids[at], k)
                    out.append(pd.DataFrame({"q": qid[i], "id": ids[at[best]], "s": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"q": [], "id": [], "s": []})

    keys = ["part", "ask"]
    return have.groupBy(*keys).cogroup(want.groupBy(*keys)).applyInPandas(probe, "q long, id long, s double")


def effort(rows: DataFrame, queries: DataFrame, model: Model) -> tuple[float, float]:
    """The mean share of all rows that a query retrieves, and that it reranks: what the index saves."""
    shared = rows.sparkSession.sparkContext.broadcast((model, np.array([r.v for r in queries.limit(200).collect()], np.float64)))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, q = shared.value
        for pdf in parts:
            if len(pdf) and len(q):
                b = Block(m, pdf["id"].to_numpy(), _matrix(pdf["v"]))
                got = [(len(at), len(b.near(c, at))) for c in m.codes(q, True) for at in [b.retrieve(c)]]
                yield pd.DataFrame({"n": [len(pdf) * len(q)], "retrieved": [sum(a for a, _ in got)], "reranked": [sum(b_ for _, b_ in got)]})

    r = rows.mapInPandas(run, "n long, retrieved long, reranked long").agg(F.sum("n"), F.sum("retrieved"), F.sum("reranked")).first()
    return r[1] / r[0], r[2] / r[0]


def nearest(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = 0.94, probe_queries: int = 200, max_codes: int = 32, model: Model | None = None) -> DataFrame:
    """Rows query_id, rank (from 1), id, score: each query's k nearest rows other than its own.

    is_query: a condition on column `id`. model: a tuned one; None: learned from df.
    """
    rows = usable(df, id_col, vector_col)
    ask = rows.filter(is_query)
    if model is None:
        model = fit(rows, max_codes)
        if model is None:
            return df.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
        model = tune(rows, ask, model, k, recall, probe_queries)
    w = Window.partitionBy("q").orderBy(F.desc("s"), "id")
    best = lambda found: found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    found = materialize(best(search(rows, ask, model, k)))
    full = found.groupBy("q").count().filter(F.col("count") >= min(k, rows.count() - 1)).select(F.col("q").alias("id"))
    rest = materialize(ask.join(full, "id", "left_anti"))
    if not rest.isEmpty():
        found = found.join(rest.select(F.col("id").alias("q")), "q", "left_anti").unionByName(best(search(rows, rest, model, k, whole=True)))
    return found.select(F.col("q").alias("query_id"), F.col("rank").cast("int").alias("rank"), "id", F.col("s").alias("score"))


def op9_ann(spark, sf_dir: str) -> DataFrame:
    out = nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return out.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
