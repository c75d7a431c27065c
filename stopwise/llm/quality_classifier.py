"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j); the pairwise sum is taken in time linear in
the features by 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2). Hashed words share 2^bits coordinates
(their vector has unit length); structure statistics are cut into bins, one coordinate each; the metadata
is the recorded length `n_chars` where the table has it (its bin and whether it equals the text's length).
Language, source, id and labels are no inputs.

Training (AdaGrad on small batches) runs in one task over at most `max_train` labelled rows chosen by
hashed id; the model has (1 + rank) x (2^bits + structure) floats whatever the input, and is broadcast.

Defined cases: null and empty texts have the structure of an empty text; very long texts are read whole;
repeated rows score alike; of an id's different texts that of the least hash is trained on, of its different
labels the least; a score at the threshold counts as good; rows with null ids are scored and never trained on;
without labels of both classes the score is the label seen (or 0.5 with none); an empty table gives an empty
result; extra columns pass through, input columns with the name of a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, bounded_sample, held_out, table
from .quality_rules import text_stats
from .textfeatures import WordHasher, scatter, split_words

_BINS = 32
_STRUCTURE = ("words", "word length", "symbols", "repeated lines", "repeated words", "line length", "capitals", "marks", "metadata length", "metadata differs")


@dataclass(frozen=True)
class Model:
    w0: float
    w: np.ndarray
    v: np.ndarray
    bits: int


def structure(text: str | None, n_chars: int | None) -> np.ndarray:
    """The bin of each structure statistic, as coordinates from 0 on."""
    n, chars, symbols, dup, rep, lines, upper, marks = text_stats(text)
    size = len(text or "")
    x = (
        2 * np.log2(n + 1),
        3 * chars / max(n, 1),
        31 * (symbols / max(chars, 1)) ** 0.5,
        31 * (dup / max(lines, 1)) ** 0.5,
        31 * (rep / max(n, 1)) ** 0.5,
        2 * np.log2(n / max(lines, 1) + 1),
        31 * (upper / max(chars, 1)) ** 0.5,
        31 * (marks / max(chars, 1)) ** 0.5,
        0 if n_chars is None else 2 * np.log2(max(n_chars, 0) + 1),
        2 if n_chars is None else int(n_chars != size),
    )
    return np.arange(len(x)) * _BINS + np.clip(np.asarray(x), 0, _BINS - 1).astype(np.int64)


def features(text: str | None, n_chars: int | None, hasher: WordHasher, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and values: structure first (value 1 each), then hashed words (logged counts, unit length)."""
    s = structure(text, n_chars)
    base = len(_STRUCTURE) * _BINS
    words = split_words(text)
    if not words:
        return s, np.ones(len(s), np.float32)
    i, c = np.unique(scatter(hasher(words), bits), return_counts=True)
    x = np.log1p(c)
    x /= np.sqrt((x * x).sum())
    return np.concatenate([s, base + i]), np.concatenate([np.ones(len(s)), x]).astype(np.float32)


def _margin(i: np.ndarray, x: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray) -> tuple[float, np.ndarray]:
    vx = v[i] * x[:, None]
    s = vx.sum(0)
    return float(w0 + w[i] @ x + 0.5 * ((s * s).sum() - (vx * vx).sum())), s


def train_fm(rows: Sequence[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, rank: int, epochs: int, rate: float, l2: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic loss, AdaGrad per coordinate, one row at a time; classes weigh alike."""
    rng = np.random.default_rng(11)
    w0, w, v = 0.0, np.zeros(size, np.float32), rng.normal(0, 0.01, (size, rank)).astype(np.float32)
    g0, gw, gv = 1.0, np.ones(size, np.float32), np.ones((size, rank), np.float32)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            i, x = rows[k]
            m, s = _margin(i, x, w0, w, v)
            d = 1 / (1 + np.exp(-np.clip(m, -35, 35))) - y[k]
            a = d * x + l2 * w[i]
            vi = v[i]
            b = d * (x[:, None] * s - vi * (x * x)[:, None]) + l2 * vi
            gw[i] += a * a
            gv[i] += b * b
            w[i] -= rate * a / np.sqrt(gw[i])
            v[i] = vi - rate * b / np.sqrt(gv[i])
            g0 += d * d
            w0 -= rate * d / g0**0.5
    return w0, w, v


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", meta_col: str = "n_chars", bits: int = 15, rank: int = 8, max_train: int = 10_000, epochs: int = 3, rate: float = 0.1, l2: float = 1e-5) -> Model:
    marked = labels.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{label_col}`").cast("int").alias("__y")).filter(F.col("__y").isin(0, 1) & ~held_out("__id")).groupBy("__id").agg(F.min("__y").alias("__y"))
    meta = F.col(f"`{meta_col}`").cast("long") if meta_col in docs.columns else F.lit(None).cast("long")
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__t"), meta.alias("__n")).join(F.broadcast(bounded_sample(marked, F.col("__id"), max_train)), "__id")
    rows = rows.groupBy("__id", "__y").agg(F.min_by(F.struct("__t", "__n"), F.xxhash64("__t", "__n")).alias("r")).select("__id", "__y", "r.*")

    def make():
        hasher = WordHasher()

        def f(texts: pa.Array, ns: pa.Array) -> list[pa.Array]:
            got = [features(t, n, hasher, bits) for t, n in zip(texts.to_pylist(), ns.to_pylist(), strict=True)]
            return [pa.array([i.astype(np.int32) for i, _ in got], pa.list_(pa.int32())), pa.array([x for _, x in got], pa.list_(pa.float32()))]

        return f

    feats = add_columns(rows, [T.StructField("i", T.ArrayType(T.IntegerType())), T.StructField("x", T.ArrayType(T.FloatType()))], ["__t", "__n"], make, keep=["__id", "__y"])
    size = len(_STRUCTURE) * _BINS + (1 << bits)

    def train(_key, pdf):
        pdf = pdf.sort_values("__id")
        y = pdf["__y"].to_numpy()
        if len(set(y)) < 2:
            return pd.DataFrame({"w0": [40.0 if y[0] else -40.0], "w": [[0.0] * size], "v": [[0.0] * size]})
        rows = list(zip(pdf["i"], pdf["x"], strict=True))
        w0, w, v = train_fm(rows, y, size, rank, epochs, rate, l2)
        return pd.DataFrame({"w0": [w0], "w": [w], "v": [v.ravel()]})

    got = feats.groupBy(F.lit(0).alias("k")).applyInPandas(train, "w0 double, w array<float>, v array<float>").collect()
    if not got:
        return Model(0.0, np.zeros(size, np.float32), np.zeros((size, 1), np.float32), bits)
    return Model(got[0].w0, np.array(got[0].w, np.float32), np.array(got[0].v, np.float32).reshape(size, -1), bits)


def score(docs: DataFrame, model: Model, text_col: str = "text", meta_col: str = "n_chars", keep: Sequence[str] | None = None, threshold: float = 0.3) -> DataFrame:
    """Append score (0 to 1, higher: better text) and predicted (1 from the threshold on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = docs.columns if keep is None else keep
    if meta_col not in docs.columns:
        docs = docs.withColumn(meta_col, F.lit(None).cast("long"))
    docs = docs.withColumn("__n", F.col(f"`{meta_col}`").cast("long"))

    def make():
        m: Model = shared.value
        hasher = WordHasher()

        def f(texts: pa.Array, ns: pa.Array) -> list[pa.Array]:
            out = np.empty(len(texts))
            for k, (t, n) in enumerate(zip(texts.to_pylist(), ns.to_pylist(), strict=True)):
                out[k] = _margin(*features(t, n, hasher, m.bits), m.w0, m.w, m.v)[0]
            p = 1 / (1 + np.exp(-np.clip(out, -35, 35)))
            return [pa.array(p), pa.array((p >= threshold).astype(np.int32))]

        return f

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return add_columns(docs, fields, [text_col, "__n"], make, keep)


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
